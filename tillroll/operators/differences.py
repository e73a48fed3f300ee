"""Difference of two tables as bags of rows (B13: what a copy lacks or has too much).

Partitions are compared by fingerprint (rows and an order-free sum of row hashes)
first. Only rows of partitions that differ are compared, each with how often it
occurs, so equal partitions cost one pass over either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_fingerprints(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, rows, hash_sum): NULL values are told from their neighbours'."""
    cells = [x for c in df.columns for x in (F.col(c), F.col(c).isNull())]
    hashed = F.xxhash64(*cells).cast("decimal(20,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).alias("hash_sum"))


def differing_partitions(source: DataFrame, copy: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partition keys whose fingerprints differ, or that one side lacks."""
    a, b = (partition_fingerprints(x, by) for x in (source, copy))
    both = a.unionByName(b).groupBy(*by, "rows", "hash_sum").agg(F.count(F.lit(1)).alias("sides"))
    return both.filter("sides <> 2").select(*by).distinct()


def bag_difference(source: DataFrame, copy: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns, then ``missing`` (times a row is in ``source`` beyond ``copy``)
    and ``surplus`` (the other way); rows with neither are left out."""
    names = source.columns
    copy = copy.select(*names)
    differ = differing_partitions(source, copy, by)
    differ = differ.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])

    def rows(df: DataFrame, sign: int) -> DataFrame:
        cond = F.lit(True)
        for i, c in enumerate(by):
            cond = cond & df[c].eqNullSafe(differ[f"_by{i}"])
        return df.join(differ, cond, "left_semi").withColumn("_sign", F.lit(sign).cast("bigint"))

    net = rows(source, 1).unionByName(rows(copy, -1)).groupBy(*names).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    zero = F.lit(0).cast("bigint")
    return net.select(*names, F.greatest("_net", zero).alias("missing"), F.greatest(-F.col("_net"), zero).alias("surplus"))
