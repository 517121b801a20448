"""All registered queries and the SQL that must give the same results."""

from __future__ import annotations

from importlib import import_module

from evenweave.catalog.registry import ORACLES, QUERIES

MODULES = ["balance", "checks", "reports", "storage", "responses", "enrichment"]


def _load() -> None:
    for name in MODULES:
        import_module(f"evenweave.catalog.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
