"""The two end-to-end jobs the reference names.

B12  object store -> Spark -> database: read landed objects, parse and type
     them, validate keys, write to the database through a staging table and
     return the swap statements (or reload a catalog table).
B13  database -> Spark -> object store: partitioned JDBC read, partitioned
     parquet backup, verified by row count and an order-free content hash.

Each job takes its source and target as arguments; the JDBC ends are thin
(``sources.jdbc`` / ``sinks.jdbc``), the work in between is plain
DataFrame code that also runs against parquet and catalog tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators import quality
from tillroll.sinks import files, jdbc as jdbc_sink, tables
from tillroll.sources import jdbc as jdbc_source


def objects_to_table(
    raw: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    key: Sequence[str],
    load: Callable[[DataFrame, str], object],
    name: str = "objects",
    rules: Sequence[quality.RowRule] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Parse ``raw`` once into a staged copy, refuse duplicate/NULL keys,
    then ``load(staged, location)``.

    The objects are read and parsed exactly once: the parsed rows are
    written as parquet under the shared folder, the key check reads only the
    key columns of that copy (and returns at most one offending row), and
    the load works from the copy. A failed check leaves the live target
    untouched.

    With ``rules``, rows that break one are not loaded: they stay in the staged copy
    (``quarantined``) with ``violations`` and all columns, the raw line among them. The
    key is checked on the others, of which ``columns`` are loaded. Returns the loaded rows.
    """
    spark = raw.sparkSession
    if not rules:
        location = tables.stage(parse(raw), f"staging.{name}")
        staged = spark.read.parquet(location)
        quality.assert_empty(quality.check_primary_key(staged, key), "key violations in input objects")
        load(staged, location)
        return staged
    marked = quality.annotate_violations(parse(raw), rules, "violations")
    state = F.when(F.size("violations") == 0, F.lit("valid")).otherwise(F.lit("quarantined"))
    location = tables.stage(marked.withColumn("load_state", state), f"staging.{name}", partition_by=["load_state"])
    valid = StructType([marked.schema[c] for c in columns or [c for c in marked.columns if c != "violations"]])
    if not tables.exists(spark, f"{location}/load_state=valid"):
        spark.createDataFrame([], valid).write.parquet(f"{location}/load_state=valid")
    staged = spark.read.schema(valid).parquet(f"{location}/load_state=valid")
    quality.assert_empty(quality.check_primary_key(staged, key), "key violations in input objects")
    load(staged, f"{location}/load_state=valid")
    return staged


def quarantined(spark: SparkSession, staged_valid: DataFrame, schema: StructType) -> DataFrame:
    """The rows that ``objects_to_table`` did not load, beside those it returned."""
    folder = staged_valid.inputFiles()[0].rsplit("/load_state=", 1)[0] + "/load_state=quarantined"
    if not tables.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def load_catalog_table(table: str) -> Callable[[DataFrame, str], None]:
    """The staged folder becomes the table's data: no second write."""

    def run(df: DataFrame, location: str) -> None:
        tables.publish(df.sparkSession, table, location, df.schema)

    return run


def load_jdbc_staged(conn: Mapping[str, str], live: str, staging: str,
                     num_partitions: int | None = None) -> Callable[[DataFrame, str], list[str]]:
    """Write a staging table and count its rows there; the returned statements
    swap it in, column by column name."""

    def run(df: DataFrame, location: str) -> list[str]:
        jdbc_sink.write_jdbc(df, conn, staging, mode="overwrite", num_partitions=num_partitions)
        want = df.count()
        counted = jdbc_source.read_jdbc(df.sparkSession, conn, query=f"select count(*) as n from {staging}")
        got = int(counted.first()[0])
        if got != want:
            raise AssertionError(f"{staging} holds {got} rows, {want} were written")
        return jdbc_sink.swap_sql(live, staging, df.columns)

    return run


def table_to_backup(source: DataFrame, path: str, partition_by: Sequence[str], verify: bool = True) -> str:
    """Back up ``source`` as partitioned parquet; optionally verify that the
    copy has the same rows (count + content hash).

    The source's fingerprint is observed during the write, so the source is
    read once; verification then reads the copy once.
    """
    if not verify:
        files.backup(source, path, partition_by)
        return path
    observed, obs = files.observed_fingerprint(source)
    files.backup(observed, path, partition_by)
    want = obs.get
    copy = source.sparkSession.read.schema(source.schema).parquet(path).select(*source.columns)
    got = files.fingerprint(copy).first()
    if (want["rows"], want["hash_sum"]) != (got["rows"], got["hash_sum"]):
        raise AssertionError(f"backup at {path} differs from its source")
    return path


def database_to_backup(spark: SparkSession, conn: Mapping[str, str], table: str, path: str,
                       partition_by: Sequence[str],
                       partition: jdbc_source.Partitioning) -> str:
    """Back up a database table; ``partition`` is required, as without it one
    connection and one task would read the whole table."""
    src = jdbc_source.read_jdbc(spark, conn, table=table, partition=partition)
    return table_to_backup(src, path, partition_by)
