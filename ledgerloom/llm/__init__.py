"""Operators for preparing training text: search, extraction, deduplication, tokens, filters, privacy, language.

Nothing else in the library imports this subpackage.
"""
