"""Column builders: pure expressions, no Python in the row path."""
