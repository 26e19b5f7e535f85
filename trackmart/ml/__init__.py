"""Popularity regression with MLlib."""
