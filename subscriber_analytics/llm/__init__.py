"""Operators for preparing training text: filters, deduplication, counting and mixing of documents."""
