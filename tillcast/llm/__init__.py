"""Training-data operators: search, dedup, tokens, mixing, extraction, filters, quality, language."""
