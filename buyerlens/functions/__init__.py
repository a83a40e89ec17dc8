"""Column expressions: calendar labels, bands, score tables and text helpers."""
