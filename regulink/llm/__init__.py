"""Corpus operators for training data: deduplication, fingerprints, scoring, filtering and packing."""
