"""Operators for preparing training text: scoring, deduplication, search, packing, formatting.

Nothing outside this subpackage imports it.
"""
