"""Totals on several levels in one pass, and distinct counts that can be merged.

Grouping sets expand a row to its levels before the (partial) aggregation; the level's
number tells a total from a group whose key is NULL. Distinct counts come
exactly, or from theta sketches stored per partition, which are merged and compared
without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_ENTRIES = 14  # 2**14 hashes a sketch: standard error about 0.8 %


def grouped_levels(df: DataFrame, keys: Sequence[str], levels: Sequence[Sequence[str]], *totals: Column) -> DataFrame:
    """``keys``, ``level`` (its place in ``levels``) and ``totals`` for each group of each
    level; a key that a level leaves out is NULL there."""
    keys = list(keys)
    grouped = df.groupingSets([[F.col(k) for k in level] for level in levels], *[F.col(k) for k in keys])
    bits = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level): n for n, level in enumerate(levels)}
    if len(bits) != len(levels):
        raise ValueError("a level is given twice")
    number = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    return (grouped.agg(F.grouping_id().cast("int").alias("_gid"), *totals)
            .withColumn("level", F.element_at(number, F.col("_gid"))).drop("_gid"))


def distinct_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Exact distinct values of several columns per group, NULLs left out."""
    return df.groupBy(*by).agg(*[F.count_distinct(F.col(c)).alias(f"n_{c}") for c in columns])


def distinct_sketches(df: DataFrame, by: Sequence[str], column: str, name: str = "sketch") -> DataFrame:
    """One theta sketch per group, to be stored; equal values always hash alike."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(F.col(column), LG_ENTRIES).alias(name))


def merged_sketches(sketches: DataFrame, by: Sequence[str], name: str = "sketch") -> DataFrame:
    """Sketches of coarser groups from stored ones, without their rows."""
    return sketches.groupBy(*by).agg(F.theta_union_agg(F.col(name), LG_ENTRIES).alias(name))


def estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch)
