"""Column expressions: keys, dates, numbers, text and value classification."""
