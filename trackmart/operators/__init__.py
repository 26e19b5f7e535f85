"""Relational operators: filters, dedup, joins, aggregates, quality checks."""
