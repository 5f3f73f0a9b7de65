"""Training-data operators: text quality, dedup, search, mixing, tokenizing and archives."""
