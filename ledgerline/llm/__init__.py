"""Operators for large training-data pipelines: text, vectors, archives, token ids."""
