"""Operators for preparing training data: labels, percentiles, clusters, vector search, packing, leakage, quality."""
