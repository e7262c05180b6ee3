"""Column expressions: column in, column out, no Python in the row path."""
