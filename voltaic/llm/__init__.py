"""Operators for preparing training text: scoring, filtering, deduplication,
extraction, formatting and tokenization of document tables."""
