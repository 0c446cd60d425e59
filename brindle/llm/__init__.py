"""Training-data operators: scoring, filtering, de-duplication, mixing, packing, extraction and search over text tables."""
