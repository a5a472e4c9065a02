"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name; ``sql`` may use the views of ``views.py``."""
    from .views import with_views

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_views(sql)
        return fn

    return keep


def load() -> None:
    for part in ("catalog", "transcripts", "languages", "tags", "state", "monitoring", "media", "streams", "full_pass"):
        import_module(f"registry.{part}")
