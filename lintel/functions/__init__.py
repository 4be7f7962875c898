"""Column expressions: text, money, area, dates, keys, scores."""
