"""Training-data operators: deduplication, mixing, counting, packing, archives, scoring and filtering of text."""
