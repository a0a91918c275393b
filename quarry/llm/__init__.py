"""Operators a training-data pipeline needs, each with its own thin registered query.

Nothing outside this subpackage (but ``corpus_pipeline.py``) imports it.
"""
