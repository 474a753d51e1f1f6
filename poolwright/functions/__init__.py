"""Column expressions and fixed code tables."""
