"""Operators for building training data at scale: filters, scans, dedup, mixing, packing and scoring."""
