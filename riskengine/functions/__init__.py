"""Column expressions shared by the operators (casts, labels, seconds, amounts, keys)."""
