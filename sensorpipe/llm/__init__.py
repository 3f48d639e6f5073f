"""Operators for training-data corpora: mixing, deduplication, classifiers, license scans, sharding, tokenizing."""
