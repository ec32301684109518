"""Column expressions: text, values, sentiment, links and page fields."""
