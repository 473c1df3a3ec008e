"""Operators for preparing training text: mixing, tokens, deduplication, quality, search, privacy, archives.

Nothing else in the package imports this folder.
"""
