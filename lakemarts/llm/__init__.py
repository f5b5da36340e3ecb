"""Operators for training data: deduplication, decontamination, packing, scoring."""
