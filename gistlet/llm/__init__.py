"""Operators for preparing training text, one module each.

Every operator takes DataFrames and returns a DataFrame; ``queries.py`` holds the
thin registered queries and ``corpus_pipeline.py`` at the top chains five of them.
Rows are documents ``(doc_id, text, ...)``; ``doc_id`` is a document's key. Only the
named columns are read, so extra columns never clash, and a null text is an empty one
unless an operator's docstring says otherwise.
"""
