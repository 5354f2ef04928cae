"""Column expressions and ordered-group helpers."""
