"""Training-data operators: scoring, deduplication, archives, sharding, rules, packing, encoding."""
