"""Operators and queries for preparing training text: tokens, duplicates, personal data, packing."""
