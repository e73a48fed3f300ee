"""Row-level operators: preview (A3), projection (A5), equality filter (A6),
computed column (A7), rename (A9), live-row filter (B11), period filter (B7).

All are narrow transformations (no shuffle) except the preview, which is a
per-task top-n followed by a merge of at most ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 20


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- A3
def preview(df: DataFrame, order_by: Sequence[str | Column] | str, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in a fixed order (``TakeOrderedAndProject``).

    The row cap is the feature here. An order key is required so the
    preview is the same on every run and every cluster size.
    """
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    if not order_by:
        raise ValueError("preview needs an order key")
    return df.orderBy(*[_col(c) for c in order_by]).limit(n)


# --------------------------------------------------------------------- A5
def project(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """Column projection; row count and duplicate rows are kept."""
    return df.select(*[_col(c) for c in cols])


# --------------------------------------------------------------------- A9
def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(dict(mapping))


# --------------------------------------------------------------------- A6
def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where ``column = value``.

    Exact comparison: case- and accent-sensitive for strings; NULL rows never
    match. On parquet the predicate reaches the scan as
    ``IsNotNull(c), EqualTo(c, v)``.
    """
    if value is None:
        raise ValueError("use an IS NULL filter for NULL; '=' never matches NULL")
    return df.filter(F.col(column) == F.lit(value))


# --------------------------------------------------------------------- A7
def add_product(df: DataFrame, name: str, a: str | Column, b: str | Column) -> DataFrame:
    """New last column ``name = a * b``; NULL in gives NULL out."""
    return df.withColumn(name, _col(a) * _col(b))


# --------------------------------------------------------------------- B11
def live_rows(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose soft-delete ``flag`` is false.

    The flag is declared NOT NULL with default false, so a NULL flag is a
    not-null violation (see ``quality.not_null_rules``), not a live row;
    ``NOT NULL`` is NULL and the row is filtered out.
    """
    return df.filter(~F.col(flag))


# --------------------------------------------------------------------- B7
def within_period(df: DataFrame, ts: str | Column, start: str | Column, end: str | Column) -> DataFrame:
    """Rows with ``start <= ts <= end`` (both bounds inclusive)."""
    return df.filter(_col(ts).between(_col(start), _col(end)))
