"""Readers, writers and pluggable search and page sources."""
