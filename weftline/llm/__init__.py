"""Operators for training data: formatting, search, duplicates, quality, archives, privacy, tokens, packing."""
