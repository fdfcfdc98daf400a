"""All registered queries."""

from __future__ import annotations

import importlib

from cartlens.catalog import registry

MODULES = (
    "sources", "cleaning", "scalars", "joins", "aggregation", "dashboard", "customers", "profiles", "learning", "streams",
)


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"cartlens.catalog.{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLES)
