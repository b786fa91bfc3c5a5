"""Operators for training-data pipelines.

Nothing outside this package (and ``corpus_pipeline.py``, which belongs to it) imports it; the root entry
module adds its queries when the package is present.
"""
