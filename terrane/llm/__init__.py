"""Operators for large training-text pipelines.

Nothing else in the library imports this subpackage, so it can be removed as a
whole together with ``corpus_pipeline.py``.
"""
