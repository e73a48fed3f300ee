"""Work along a global order, without one task for a hot key or for all rows.

The rows are range-partitioned by key and order and written with the number of
their part, which fixes the parts. Inside a part a window does the work; what a
part has to know of earlier ones (a count, a total, a last row) is one row per part
and key, carried along by a window over these rows. A key that holds half of all
rows is spread over many parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.sinks import tables

PART = "_part"


def ordered_parts(df: DataFrame, order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` in parts along ``order``, with the part's number in ``_part``. Without
    ``parts``, adaptive execution chooses their number by size."""
    placed = df.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())
    return df.sparkSession.read.schema(placed.schema).parquet(tables.stage(placed, "ordered"))


def _carried(per_part: DataFrame, keys: Sequence[str], carry: Column) -> DataFrame:
    """(_part, keys, _carry) where ``carry`` over the earlier parts of a key is not null."""
    named = [F.col(k).alias(f"_of_{k}") for k in keys]
    return (per_part.withColumn("_carry", carry).filter("_carry IS NOT NULL")
            .select(F.col(PART).alias("_of_part"), *named, "_carry"))


def _with_carry(df: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = df[PART] == carried["_of_part"]
    for k in keys:
        cond = cond & df[k].eqNullSafe(carried[f"_of_{k}"])
    return df.join(carried, cond, "left")


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_number", parts: int | None = None) -> DataFrame:
    """``df`` with gapless numbers from 1 along ``order`` (which should have no
    ties; tied rows are numbered in any order)."""
    parts = ordered_parts(df, order, parts)
    counts = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))  # one row per part
    inside = F.row_number().over(Window.partitionBy(PART).orderBy(*order))
    numbered = _with_carry(parts.withColumn("_inside", inside), _carried(counts, [], earlier), [])
    return numbered.select(*df.columns, (F.coalesce("_carry", F.lit(0).cast("bigint")) + F.col("_inside")).alias(name))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
                  parts: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the key's rows up to each one along
    ``order`` (which should have no ties within a key). NULL values count as nothing; NULL keys are a key."""
    keys = list(keys)
    parts = ordered_parts(df, [*keys, *order], parts)
    totals = parts.groupBy(PART, *keys).agg(F.sum(value).alias("_total"))
    earlier = F.sum("_total").over(Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    inside = F.sum(value).over(Window.partitionBy(PART, *keys).orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = _with_carry(parts.withColumn("_inside", inside), _carried(totals, keys, earlier), keys)
    total = F.when(F.col("_carry").isNull(), F.col("_inside")).when(F.col("_inside").isNull(), F.col("_carry")).otherwise(
        F.col("_carry") + F.col("_inside"))
    return summed.select(*df.columns, total.cast(totals.schema["_total"].dataType).alias(name))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              take: Sequence[str], tie: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Every row of ``left`` with the columns ``take`` of the last ``right`` row of
    its key at or before its time (ties: the largest ``tie``); NULL where there
    is none. Rows of ``right`` without a time match nothing; NULL keys match nothing."""
    keys, none = list(keys), F.lit(False)
    for k in keys:
        none = none | F.col(k).isNull()
    found = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(take)])
    ties = [F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)]
    r = right.filter(F.col(right_time).isNotNull() & ~none).select(
        *keys, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), *ties, found.alias("_right"))
    row = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(left.columns)])
    blank = [F.lit(None).cast(t).alias(n) for n, t in r.dtypes if n.startswith("_tie")]
    le = left.select(*keys, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), *blank, row.alias("_left"), none.alias("_none"))
    order = ["_time", "_side", *[f"_tie{i}" for i in range(len(tie))]]
    both = r.unionByName(le, allowMissingColumns=True)
    parts = ordered_parts(both, [*keys, *order], parts)
    window = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.when(F.col("_side") == 0, F.struct(*order))
    lasts = parts.groupBy(PART, *keys).agg(F.max_by("_right", last).alias("_last"))
    earlier = F.last("_last", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    inside = parts.withColumn("_inside", F.last("_right", ignorenulls=True).over(window)).filter("_side = 1")
    joined = _with_carry(inside, _carried(lasts, keys, earlier), keys)
    match = F.when(~F.col("_none") & F.col("_time").isNotNull(), F.coalesce("_inside", "_carry"))
    return joined.withColumn("_match", match).select(
        *[F.col(f"_left.v{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"_match.v{i}").alias(c) for i, c in enumerate(take)])
