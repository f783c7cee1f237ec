"""Every operator applied to the shared test tables, with its SQL twin."""

from __future__ import annotations

from . import clean_queries, match_queries, series_queries, source_queries

_MODULES = (series_queries, match_queries, clean_queries, source_queries)

# Name -> (callable(spark, sf_dir), SQL or None).
CATALOG = {name: pair for module in _MODULES for name, pair in module.QUERIES.items()}
