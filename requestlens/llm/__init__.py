"""Operators for training data: scoring, deduplication, decontamination, mixing and sharding of text tables."""
