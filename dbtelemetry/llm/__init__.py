"""Operators for large-scale training-data pipelines (documents and embeddings).

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` registers them.
"""
