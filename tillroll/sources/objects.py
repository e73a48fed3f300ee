"""Recursive object listing (name, size, modification time).

Uses the ``binaryFile`` source without selecting ``content``, so file bytes
are never read; the file index lists in parallel but keeps the file statuses on
the driver, so a very large store should be listed from its inventory table (``from_inventory``). Works on
any Hadoop-compatible path (``file:``, ``s3a:``, ``abfs:`` ...) given the
right connector on the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

LISTING_SCHEMA = StructType([
    StructField("path", StringType()),
    StructField("name", StringType()),
    StructField("length", LongType()),
    StructField("modificationTime", TimestampType()),
])


def list_objects(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Every file below ``root`` (hidden ``_``/``.`` files excluded) with its
    path relative to ``root`` as ``name``. An empty or missing prefix gives
    zero rows rather than an error."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root).select("path", "length", "modificationTime")
    except Exception as e:  # empty prefix: Spark cannot infer anything to read
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], LISTING_SCHEMA)
        raise
    # names relative to the root: the path is plain text, so the prefix is cut literally
    prefix = F.lit(_strip_scheme(root.rstrip("/") + "/"))
    rel = F.col("path").substr(F.instr(F.col("path"), prefix) + F.length(prefix), F.length("path"))
    return files.select("path", rel.alias("name"), "length", "modificationTime")


def from_inventory(inventory: DataFrame, key: str, size: str, modified: str, prefix: str = "") -> DataFrame:
    """The columns of ``list_objects`` from a store's inventory table (one row
    per object), of the objects below ``prefix``. The table is read like any
    other, so no file status reaches the driver."""
    below = inventory.filter(F.col(key).startswith(prefix))
    return below.select(F.col(key).alias("path"), F.col(key).substr(F.lit(len(prefix) + 1), F.length(key)).alias("name"),
                        F.col(size).cast("long").alias("length"), F.col(modified).cast("timestamp").alias("modificationTime"))


def _strip_scheme(p: str) -> str:
    if p.startswith("file:"):
        p = p[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
    return p
