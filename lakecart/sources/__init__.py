"""Sources S1–S7: bus and file envelopes, the product catalog, layer tables, JSON-lines files."""
