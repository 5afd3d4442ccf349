"""Operators of a training-data pipeline and their queries.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Each module
holds one operator with its own interface; ``catalog`` registers the thin
``opN_<name>`` queries over the given tables.
"""
