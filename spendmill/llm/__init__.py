"""Operators for text corpora: scans, deduplication, counting, packing and extraction. Nothing outside imports this."""
