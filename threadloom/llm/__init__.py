"""Training-data operators: dedup, search, scans, tokenisation and archives."""
