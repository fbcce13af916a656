"""Column expressions: no actions, no Python per row."""
