"""Column expressions: NULL rules, text, calendar and numeric helpers."""
