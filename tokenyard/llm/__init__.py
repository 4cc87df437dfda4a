"""Operators of a training-data pipeline: formatting, deduplication, scoring, mixing, packing, sharding."""
