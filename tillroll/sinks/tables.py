"""Catalog tables: A15 append by name, A23 reload (write beside, then swap).

A reload never overwrites the files it may be reading. The new data goes to
a fresh folder under the shared folder; the table is then pointed at it
(``ALTER TABLE ... SET LOCATION``) in one catalog operation. Running the
same reload twice gives the same table. The previous folder is left in
place for readers still on the old version and for rollback; removing old
versions is a retention policy of the storage (e.g. a bucket lifecycle
rule), not part of the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.load import fill_defaults
from tillroll.session import shared_path


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def stage(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (), compression: str | None = None) -> str:
    """Write ``df`` to a fresh folder under the shared folder; return it."""
    location = shared_path(df.sparkSession, "tables", table.replace(".", "_"), unique=True)
    w = df.write.mode("errorifexists").format(fmt).partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.save(location)
    return location


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, on any file system that Spark reads."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return True


def publish(spark: SparkSession, table: str, location: str, schema, fmt: str = "parquet") -> None:
    """Point ``table`` at a staged folder (one catalog operation); create the
    table when missing. Other columns or another format than the table's are
    refused, as the new folder would be read by the old definition."""
    check_definition(spark, table, schema, fmt)
    if spark.catalog.tableExists(table):
        path = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {_quote(table)} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=location, source=fmt, schema=schema)


def check_definition(spark: SparkSession, table: str, schema, fmt: str) -> None:
    """Raise if ``table`` exists with other columns, types or another format."""
    if not spark.catalog.tableExists(table):
        return
    old, new = ([(f.name, f.dataType.simpleString()) for f in x.fields] for x in (spark.table(table).schema, schema))
    provider = (spark.sql(f"DESCRIBE TABLE EXTENDED {_quote(table)}")
                .filter("col_name = 'Provider'").first())
    if old != new or (provider and provider["data_type"].lower() != fmt.lower()):
        raise ValueError(f"{table} has another definition: {old} ({provider and provider['data_type']}), "
                         f"reload brings {new} ({fmt}); drop or alter the table first")


def reload(df: DataFrame, table: str, fmt: str = "parquet") -> str:
    """Replace ``table``'s contents with ``df``; create it when missing."""
    check_definition(df.sparkSession, table, df.schema, fmt)
    location = stage(df, table, fmt)
    publish(df.sparkSession, table, location, df.schema, fmt)
    return location


def append_by_name(df: DataFrame, table: str, defaults: Mapping[str, Column] | None = None) -> None:
    """``INSERT INTO table (cols...)``: columns are matched by name, columns
    absent from ``df`` take their default (or fail), extra columns fail."""
    spark = df.sparkSession
    target = spark.table(table).schema
    df = fill_defaults(df, defaults or {})
    names = {f.name for f in target.fields}
    extra = [c for c in df.columns if c not in names]
    if extra:
        raise ValueError(f"columns not in {table}: {extra}")
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns without value or default: {missing}")
    ordered = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])
    ordered.write.insertInto(table, overwrite=False)
