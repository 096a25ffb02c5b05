"""Operators of a training-data pipeline: mixing, near-duplicates, scans, packing, scoring and fingerprints."""
