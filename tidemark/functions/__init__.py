"""Column expressions and the names they work on."""
