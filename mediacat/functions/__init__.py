"""Column expressions: no shuffle, no Python rows."""
