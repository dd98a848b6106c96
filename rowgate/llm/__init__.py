"""Operators for training-data corpora: documents, embeddings and web pages.

Nothing else in the library imports this package.
"""
