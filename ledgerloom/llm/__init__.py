"""Training-data operators: deduplication, tokenizing, packing, filtering and vector search."""
