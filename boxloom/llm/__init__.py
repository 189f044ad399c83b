"""Operators for large text corpora: dedup, counting, filters, classifiers, search, tokenizing."""
