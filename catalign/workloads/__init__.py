"""Registered queries: each binds an operator to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from catalign.tables import Tables


class Query(NamedTuple):
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with the SQL that must give the same rows."""

    def wrap(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return wrap


def load_all() -> dict[str, Query]:
    """Import every workload module once and return the registry."""
    import importlib
    import pkgutil

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return REGISTRY
