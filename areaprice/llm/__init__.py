"""Operators for text corpora: deduplication, quality, personal data, mixing, packing, language and token counts."""
