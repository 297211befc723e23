"""Operators for preparing text corpora; nothing outside this package depends on it."""
