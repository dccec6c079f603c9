"""Readers, writers and the review view over order tables."""
