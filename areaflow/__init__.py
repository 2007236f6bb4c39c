"""Spark operators and marts for per-area, minute-level city observations."""
