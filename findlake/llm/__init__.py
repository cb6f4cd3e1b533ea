"""Operators for preparing training texts: filters, deduplication, extraction, packing."""
