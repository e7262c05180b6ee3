"""Operators for training-text corpora: dedup, quality, mixing, tokens, search, fixity."""
