"""Operators of a training-data pipeline, each by its own method; see the module docstrings."""
