"""Every operator as a query over the given tables, with its SQL counterpart."""

from __future__ import annotations


def _modules():
    from gleanery.catalogue import exports, imports, loading, logs, runs

    return [exports, imports, logs, loading, runs]


def all_queries() -> dict:
    return {name: f for module in _modules() for name, f in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: text for module in _modules() for name, text in module.SQL.items()}
