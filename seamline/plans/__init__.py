"""Registered queries: ``QUERIES`` maps a name to a callable, ``ORACLES`` to DuckDB SQL."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from seamline.session import ship
from seamline.sources.views import oracle as with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "pose_coarse_search"
_MODULES = ("runlog", "sequences", "names", "tokens", "streets", "places", "fits", "connectors", "judgements", "locate", "extras")


def query(sql: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir) under its name, with the SQL that must give the same rows."""

    def add(run: Callable) -> Callable:
        @functools.wraps(run)
        def shipped(spark, sf_dir):
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = shipped
        if sql:
            ORACLES[run.__name__] = with_views(sql)
        return run

    return add


def load() -> None:
    """Import the plan modules; each registers its queries."""
    for name in _MODULES:
        importlib.import_module(f"seamline.plans.{name}")
