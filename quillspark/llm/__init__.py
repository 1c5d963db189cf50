"""Training-data operators: counting, sharding, deduplication, filtering, formatting and packing."""
