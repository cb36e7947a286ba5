"""Training-data operators: filters, scoring, search, deduplication, archives and mixing."""
