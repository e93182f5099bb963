"""Operators for training data: ten methods over documents, pages and embeddings."""
