"""Column expressions: each takes and returns Columns and never touches data."""
