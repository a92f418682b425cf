"""Operators that prepare training text: tokenising, filtering, deduplicating, scoring and packing."""
