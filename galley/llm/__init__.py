"""Operators of a training-data pipeline: dedup, tokens, packing, cleaning."""
