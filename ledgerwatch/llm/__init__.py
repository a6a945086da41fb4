"""Operators for preparing training text: duplicates, leaks, tokens, filters, packing, models."""
