"""Column expressions: text, contact fields, dates and similarity."""
