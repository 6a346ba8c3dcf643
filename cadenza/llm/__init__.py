"""Operators of a training-data pipeline, each by one named method, as Spark jobs.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
