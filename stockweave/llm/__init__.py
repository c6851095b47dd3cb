"""Operators for preparing training data: text quality, duplicates, contamination, personal data, packing."""
