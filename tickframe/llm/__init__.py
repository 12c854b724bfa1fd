"""Training-data operators: deduplication, filtering, scoring, packing, token counts."""
