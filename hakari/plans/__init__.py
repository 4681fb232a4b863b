"""Catalogue of queries with their reference SQL."""
