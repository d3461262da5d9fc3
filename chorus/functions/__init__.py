"""Column expressions: text cleaning, tokens, keys, dates and links."""
