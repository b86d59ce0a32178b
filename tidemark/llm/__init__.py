"""Operators for training-data pipelines over documents, chats and embeddings."""
