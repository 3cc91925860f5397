"""Transformations that aggregate, join, rank, sample, score or train."""
