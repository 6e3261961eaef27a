"""Operators for preparing training text at scale, one module each.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
