"""Column functions: pure expressions, no joins and no actions."""
