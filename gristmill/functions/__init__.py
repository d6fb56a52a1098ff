"""Column expressions without a shuffle."""
