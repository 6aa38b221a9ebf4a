"""Loaders applied to the raw rows of a run, chosen by name."""

from __future__ import annotations

from collections.abc import Callable

_LOADERS: dict[str, Callable] = {}


def register(name: str, loader: Callable | None = None) -> Callable:
    """Register a loader `f(tables, changes) -> tables`; usable as a decorator.

    `tables` maps table names to DataFrames; `changes` is a `consolidate.Changes`.
    """
    if loader is None:
        return lambda fn: register(name, fn)
    _LOADERS[name] = loader
    return loader


def get(name: str) -> Callable:
    if name not in _LOADERS:
        raise KeyError(f"no loader named {name!r}; known: {sorted(_LOADERS)}")
    return _LOADERS[name]


def names() -> list[str]:
    return sorted(_LOADERS)
