"""Column builders: pure expressions, no DataFrame and no action."""
