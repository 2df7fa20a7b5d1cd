"""Operators for preparing training data: packing, near-duplicates, scoring, redaction, archives."""
