"""B1: JSON documents.

Pretty-printed files (one JSON value per file, object or array root) need
``multiLine``; such files cannot be split, so a large document set is read
once and landed as parquet (``land``), after which nested column pruning
and predicate pushdown work. NDJSON (one document per line) is splittable
and is read without ``multiLine``. The schema is always given: inference
would scan everything twice and turns an always-null field into ``string``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Records that do not parse fail the read instead of becoming NULL rows.
_STRICT = {"mode": "FAILFAST"}


CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True,
              recursive: bool = True, keep_malformed: bool = False) -> DataFrame:
    """Read documents with ``schema``. By default a malformed document fails
    the read. ``keep_malformed`` keeps going instead: such a record comes
    back with NULL fields and its raw text in ``_corrupt_record``; a row
    rule ``_corrupt_record IS NOT NULL`` sends it to quarantine."""
    if keep_malformed:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = spark.read.schema(schema).option("mode", "PERMISSIVE") \
            .option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = spark.read.schema(schema).options(**_STRICT)
    reader = reader.option("multiLine", multi_line)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path)


def land(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write parsed documents as parquet once; later jobs read that copy."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
