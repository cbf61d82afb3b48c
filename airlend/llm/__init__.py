"""Operators that prepare text for training: deduplication, tokens, language, secrets, search, packing."""
