"""Preparing training data: ten operators over documents, pages and embeddings."""
