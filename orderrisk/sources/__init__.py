"""Readers, writers and the adapters that derive order feeds from the given tables."""
