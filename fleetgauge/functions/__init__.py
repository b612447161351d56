"""Column expressions: text, time and comparison codes."""
