"""Operators for training-data corpora: text, URLs, vectors, mixing and token files.

Nothing else in the library imports this package.
"""
