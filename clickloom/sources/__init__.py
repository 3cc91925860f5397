"""Readers, writers and the adapters that derive impressions from the test tables."""
