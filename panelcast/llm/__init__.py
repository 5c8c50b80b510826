"""Training-data operators: quality, deduplication, packing and archives."""
