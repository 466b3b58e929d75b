"""Operators of a training-data pipeline: ten methods over documents and embeddings."""
