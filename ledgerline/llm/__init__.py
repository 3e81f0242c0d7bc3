"""Operators for large-scale training-data preparation (text in, decisions out).

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
