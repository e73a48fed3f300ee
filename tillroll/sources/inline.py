"""A1: a DataFrame from rows held by the caller.

Only for small reference data (lookup lists, fixtures). The schema is always
explicit, never inferred, so a column of whole numbers stays the declared type.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def inline_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType,
                max_rows: int | None = None) -> DataFrame:
    """The rows are serialised into the plan. A caller that wants to keep that
    small sets ``max_rows``: more rows are refused, none are dropped."""
    rows = [tuple(r) for r in rows]
    if max_rows is not None and len(rows) > max_rows:
        raise ValueError(f"{len(rows)} inline rows; land larger data as files and read them instead")
    width = len(schema.fields)
    for r in rows:
        if len(r) != width:
            raise ValueError(f"row {r!r} has {len(r)} values, schema has {width}")
    return spark.createDataFrame(rows, schema)
