"""Operators for preparing training text: deduplication, mixing, packing, extraction, scoring."""
