"""Whole recipes and batch jobs composed from the operators."""
