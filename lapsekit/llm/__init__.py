"""Training-data operators: archives, near-duplicates, tokens, packing, filters, scans, extraction."""
