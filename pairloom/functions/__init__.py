"""Column expressions over built-in functions."""
