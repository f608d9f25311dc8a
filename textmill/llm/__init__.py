"""Operators for training-data pipelines: tokenising, language ID, deduplication, filtering, formatting.

Nothing else in the library imports this subpackage.  Operators take and return DataFrames;
``textmill.llm.queries`` registers one query per operator.
"""
