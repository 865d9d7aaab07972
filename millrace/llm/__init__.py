"""Operators for training-data pipelines: dedup, fingerprints, mixing, extraction, packing, counts, quality."""
