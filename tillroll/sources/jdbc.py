"""A10: database source over JDBC.

Connection settings are passed in by the caller (from a secret store or job
arguments), never written in code. Tables are read in parallel: with a
numeric, date or timestamp ``partition_column`` and its bounds, Spark opens
``num_partitions`` connections, each reading one stride. Filters and column
projections applied to the result are pushed into the SQL sent to the
database. Read errors surface as job failures, they are not swallowed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REQUIRED = ("url",)


@dataclass(frozen=True)
class Partitioning:
    column: str
    lower: int | str
    upper: int | str
    num_partitions: int


def jdbc_options(conn: Mapping[str, str], table: str | None = None, query: str | None = None,
                 partition: Partitioning | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; exactly one of ``table`` / ``query``."""
    missing = [k for k in _REQUIRED if not conn.get(k)]
    if missing:
        raise ValueError(f"connection settings missing: {missing}")
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    if partition is not None and query is not None:
        # Spark cannot combine 'query' with partitionColumn; wrap as a subquery
        table, query = f"({query}) AS q", None
    opts = {k: str(v) for k, v in conn.items()}
    opts["fetchsize"] = str(fetch_size)
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition is not None:
        if partition.num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        opts.update({
            "partitionColumn": partition.column,
            "lowerBound": str(partition.lower),
            "upperBound": str(partition.upper),
            "numPartitions": str(partition.num_partitions),
        })
    return opts


def read_jdbc(spark: SparkSession, conn: Mapping[str, str], table: str | None = None,
              query: str | None = None, partition: Partitioning | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(conn, table, query, partition)).load()


def read_jdbc_parts(spark: SparkSession, conn: Mapping[str, str], table: str, predicates: list[str]) -> DataFrame:
    """``table`` with one task for each condition (``equi_depth_predicates``)."""
    rest = {k: v for k, v in jdbc_options(conn, table).items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(conn["url"], table, predicates=predicates, properties=rest)


def server_version(spark: SparkSession, conn: Mapping[str, str]) -> DataFrame:
    """Connectivity probe: the database's version string as a one-row frame."""
    return read_jdbc(spark, conn, query="SELECT version() AS version")


def equi_depth_predicates(keys: DataFrame, column: str, parts: int) -> list[str]:
    """Conditions on a numeric, date or text key for about equal numbers of rows each: NULL
    keys, then ranges without gap or overlap over all values. ``keys`` holds the key
    column, or a sample of it: the cuts only balance the parts, every row is in
    exactly one whatever they are. A value that is most of a table stays one part."""
    kind = keys.schema[column].dataType
    if isinstance(kind, (T.StringType, T.DateType)):
        counts = keys.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        total = counts.agg(F.sum("n")).first()[0] or 0
        upto = F.sum("n").over(Window.orderBy(column))
        if counts.count() > 1_000_000:  # one task would number them
            raise ValueError("give a sample of the keys")
        step = F.ceil(upto * F.lit(parts) / F.lit(max(1, total)))
        ends = counts.select(column, step.alias("s")).filter(F.col("s") < parts).groupBy("s").agg(F.max(column).alias("c"))
        cuts = sorted(r["c"] for r in ends.collect())
    else:
        found = keys.agg(F.percentile_approx(column, [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
        cuts = sorted(set(found or []))

    def literal(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"DATE '{v}'" if isinstance(kind, T.DateType) else f"TIMESTAMP '{v}'" if isinstance(v, datetime) else str(v)

    out = [f"{column} IS NULL"]
    edges = [literal(c) for c in cuts]
    for lo, hi in zip([None, *edges], [*edges, None]):
        both = [f"{column} > {lo}" if lo is not None else "", f"{column} <= {hi}" if hi is not None else ""]
        out.append(" AND ".join(x for x in both if x) or f"{column} IS NOT NULL")
    return out
