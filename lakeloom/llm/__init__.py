"""Operators of a training-data pipeline: mixing, dedup, archives, labelling, search."""
