"""Operators for preparing training corpora: mixing, deduplication, archives, search, packing, scoring."""
