"""Operators for training-data pipelines: dedup, decontamination, mixing, filters, sharding, search."""
