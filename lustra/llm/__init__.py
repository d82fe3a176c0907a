"""Operators for training data: quality, deduplication, extraction, decontamination, tokens."""
