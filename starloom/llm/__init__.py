"""Operators for preparing training data: scans, near-duplicates, classifiers, token output, packing."""
