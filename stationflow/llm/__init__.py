"""Operators of a training-data pipeline (quality, tokens, duplicates, search)."""
