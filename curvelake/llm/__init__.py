"""Operators for preparing text corpora: filters, deduplication, scans, scoring, tokens, packing."""
