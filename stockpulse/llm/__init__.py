"""Operators for training-data corpora: language, mixing, quality, near
duplicates, secrets, tokens, shards, toxicity, lines and decontamination.

Nothing else in the library imports this subpackage.
"""
