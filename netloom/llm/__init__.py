"""Operators for preparing training text; queries are in ``queries``.

Nothing outside this folder imports it, apart from the query list of
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
