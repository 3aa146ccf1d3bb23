"""Operators for building training corpora: archives, extraction, near copies, quality, mixing, tokens."""
