"""Column expressions (scalar functions) and column-selection helpers."""
