"""Operators of a training-data pipeline: secrets, archives, tokens, dedup, models, search.

Nothing outside this package imports it.  ``llm.queries`` holds the registered
queries ``opN_*`` and their SQL.
"""
