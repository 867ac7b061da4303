"""Column expressions of the load-survey rules."""
