"""Operators for preparing training text: archives, extraction, tokens, duplicates, packing."""
