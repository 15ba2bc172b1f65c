"""Training-data operators: search, dedup, scans, language id, mixing, sharding, tokenising, quality."""
