"""Column expressions and per-row DataFrame steps."""
