"""Training-data operators on Spark: dedup, filtering, tokenising, packing, search."""
