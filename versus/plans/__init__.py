"""Query catalog (``queries()`` / ``oracle_sql()``) and end-to-end flows."""

from __future__ import annotations

import importlib

_CATALOGS = ("catalog_merge", "catalog_pregame", "catalog_eval", "catalog_features", "catalog_stats", "catalog_scalar", "catalog_models", "catalog_io", "catalog_pipeline")


def load_catalog():
    """Import every catalog module so their queries register; return the registry."""
    for name in _CATALOGS:
        importlib.import_module(f"{__name__}.{name}")
    from .registry import ORACLE, QUERIES
    return QUERIES, ORACLE
