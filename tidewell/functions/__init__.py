"""Column expressions: text, dates, amounts and codes."""
