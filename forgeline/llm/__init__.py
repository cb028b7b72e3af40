"""Training-data operators: dedup, scoring, quality, search, tokenization and packing of documents."""
