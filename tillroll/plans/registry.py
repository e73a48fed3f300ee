"""Query registry: a Spark builder and, where SQL can say the same thing,
the oracle SQL next to it.

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables at that scale. Every computed column carries the same alias in
the builder and in the SQL so results compare column by column.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: tuple[str, ...]


_REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under ``name``; ``ops`` lists the SURVEY ids covered."""

    def wrap(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql.strip() if sql else None,
                                tuple(o.strip() for o in ops.split(",")))
        return fn

    return wrap


def _load_all() -> None:
    # importing the modules registers their queries
    from tillroll.plans import (  # noqa: F401
        q_basic, q_documents, q_io, q_model, q_ordered, q_quality, q_versions,
    )


def all_queries() -> dict[str, Query]:
    _load_all()
    return dict(_REGISTRY)
