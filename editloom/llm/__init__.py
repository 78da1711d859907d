"""Operators for preparing training text: fingerprints, tokens, shards, mixtures, near-duplicates.

Nothing outside this subpackage imports it.
"""
