"""Operators for training data and record linkage at scale. Nothing outside this package imports it."""
