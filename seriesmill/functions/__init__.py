"""Column expressions and the JSON codec."""
