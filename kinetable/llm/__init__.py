"""Training-data operators: near-dedup, filters, tokens, mixing. Nothing else in the library imports this."""
