"""Readers, writers and the raw-layer manifest."""
