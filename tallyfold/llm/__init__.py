"""Operators that prepare training text: extraction, cleaning, deduplication, scoring, search, mixing."""
