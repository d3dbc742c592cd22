"""Operators for preparing training data: mixing, near-duplicates, classifiers, scans, search."""
