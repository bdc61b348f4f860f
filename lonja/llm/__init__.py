"""Operators of a training-data pipeline: scoring, deduplication, decontamination, packing and sharding of documents."""
