"""Training-data operators: secrets, mixing, similarity joins, language, packing, toxicity, search, sharding, dedup."""
