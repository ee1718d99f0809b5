"""Operators for preparing large text corpora for language-model training.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. ``registry`` lists
the queries that ``__spark_entry__.py`` adds when the subpackage is present.
"""
