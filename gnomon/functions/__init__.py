"""Column functions: no Python runs per row."""
