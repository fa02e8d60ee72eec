"""Training-data operators: search, sharding, language id, quality, packing, extraction, dedup, mixing."""
