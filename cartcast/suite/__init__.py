"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``
and, where SQL can express the same result, ``ORACLE[name]`` (DuckDB SQL
over the driver tables registered as views)."""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``. The driver tables hold wall-clock
    (``timestamp_ntz``) times; the session time zone is pinned to UTC so
    casts to instants (watermarks, windows, elapsed seconds) are the same
    arithmetic as the SQL twins in any caller's session."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            from ..session import ship_package
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            # cached model inputs are coalesced by AQE like any shuffle output
            spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every suite module so its queries register."""
    from . import (  # noqa: F401
        q_features,
        q_sources,
        q_relational,
        q_scalar,
        q_metrics,
        q_mlfeatures,
        q_streaming,
        q_jobs,
        q_models,
    )
