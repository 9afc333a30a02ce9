"""Reusable relational blocks; the plans are compositions of these."""
