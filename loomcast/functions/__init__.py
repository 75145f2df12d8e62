"""Column functions: every one returns built-in column expressions."""
