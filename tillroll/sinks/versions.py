"""A22 without a full rewrite: a table as a list of files per version.

``root/data`` holds the files, ``root/versions/v=N`` the list of those that make up
version N. An update finds the files that hold its keys (``_metadata.file_path``), writes only
those anew and publishes a list of old and new files last. Readers of the last
version see nothing before that; a failed update leaves files that no list names.
One writer at a time, as the shared folder has no lock: publishing a version that exists is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators.update import update_rows


def create(df: DataFrame, root: str) -> None:
    """Version 0 of a table from ``df``."""
    df.write.mode("errorifexists").parquet(f"{root}/data/v=0")
    _publish(df.sparkSession, root, 0, _names(df.sparkSession, f"{root}/data/v=0", df.schema))


def latest(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/versions").agg(F.max("v")).first()[0]


def file_list(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(file): the files of a version, the last one by default."""
    version = latest(spark, root) if version is None else version
    return spark.read.schema("file string").parquet(f"{root}/versions/v={version}")


def read(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of a version. Its file names pass the driver, as those of any read do."""
    files = [r[0] for r in file_list(spark, root, version).collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def update(spark: SparkSession, root: str, schema: StructType, updates: DataFrame, key: str, stamp_col: str, now: Column,
           protected: Sequence[str] = ()) -> int:
    """Apply a batch (rules of ``operators.update``) to the files that hold its
    keys; returns the new version, or the old one if no file does."""
    version = latest(spark, root)
    table = read(spark, root, schema)
    holding = table.select(key, F.col("_metadata.file_path").alias("file")).join(updates.select(key), key, "left_semi")
    touched = [r[0] for r in holding.select("file").distinct().collect()]  # file names, as in a read
    if not touched:
        return version
    part = spark.read.schema(schema).parquet(*touched)
    folder = f"{root}/data/v={version + 1}"
    update_rows(part, updates, key, stamp_col, now, protected).write.mode("overwrite").parquet(folder)
    kept = file_list(spark, root, version).filter(~F.col("file").isin(touched))
    _publish(spark, root, version + 1, kept.unionByName(_names(spark, folder, schema)))
    return version + 1


def _names(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Files that hold rows, as Spark names them in ``_metadata``."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select(F.col("_metadata.file_path").alias("file"))


def _publish(spark: SparkSession, root: str, version: int, files: DataFrame) -> None:
    files.coalesce(1).write.mode("errorifexists").parquet(f"{root}/versions/v={version}")
