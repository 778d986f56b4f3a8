"""Column builders: pure expressions, no actions."""
