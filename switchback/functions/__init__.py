"""Column expressions: rounding, text rules, geometry, names."""
