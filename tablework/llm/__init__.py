"""Operators for preparing training text at scale, one module each.

``queries.py`` registers one whole-table query per operator; nothing outside
this subpackage (and ``corpus_pipeline.py``) imports it.
"""
