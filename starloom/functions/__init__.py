"""Column expressions: calendar arithmetic, derived attributes, keys and exact ratios."""
