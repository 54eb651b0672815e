"""Training-data operators: extraction, scoring, sharding, deduplication, packing and encoding."""
