"""Operators of a training-data pipeline at corpus scale.

One module per operator; ``queries`` binds them to the test tables. Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
