"""Column expressions: identifiers, times and message texts."""
