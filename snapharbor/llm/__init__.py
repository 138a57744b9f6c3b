"""Operators for preparing training text, embeddings and conversations."""
