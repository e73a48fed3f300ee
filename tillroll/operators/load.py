"""A14 typed load and A16 default fill.

``conform`` turns any input frame into a declared schema: columns are
matched by name, cast to the declared type and put in declared order.
Under ANSI mode a value that does not fit (e.g. 10^8 into NUMERIC(10,2),
a too-large integer into INT) fails the job instead of wrapping or turning
into NULL; use the quality rules first to quarantine such rows.

``fill_defaults`` applies a default only to a column that is **absent** from
the input, the way ``INSERT INTO t (cols...)`` fills omitted columns. An
explicit NULL stays NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    df = fill_defaults(df, defaults or {})
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing and without default: {missing}")
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    if extra:
        raise ValueError(f"columns not in schema: {extra}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def fill_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    absent = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
