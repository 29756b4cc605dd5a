"""Operators for large text corpora: tokenising, language id, near-duplicates, audits, packing."""
