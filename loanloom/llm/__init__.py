"""Training-data operators: token counts, deduplication, mixing, personal data, quality, packing, sharding."""
