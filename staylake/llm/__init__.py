"""Training-data operators: packing, language id, near-duplicate joins, license scans, quality,
binary code search, token files, vector search, paragraph dedup and source mixing."""
