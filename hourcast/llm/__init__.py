"""Training-data operators: deduplication, tokenizing, mixing, classification, archives and vector search."""
