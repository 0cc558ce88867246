"""Corpus preparation: filters, deduplication, mixing and token output for text collections."""
