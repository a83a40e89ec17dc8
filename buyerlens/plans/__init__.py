"""Whole jobs assembled from operators."""
