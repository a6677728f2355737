"""Operators for large text corpora: filters, deduplication, scoring, tokenisation."""
