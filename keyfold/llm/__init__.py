"""Operators for preparing training data, one module each.

``queries.py`` holds the thin ``opN_*`` queries and their DuckDB SQL; the
operators take DataFrames and keep their own, more general interface.  Nothing
outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
