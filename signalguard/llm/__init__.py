"""Operators that prepare training text: filters, near-duplicates, scoring, encoding."""
