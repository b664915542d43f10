"""Operators that prepare training text: archives, deduplication, filters, mixing, tokens."""
