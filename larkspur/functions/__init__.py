"""Column expressions: text cleaning, tokens, numbers and dates."""
