"""B12, incremental: new objects in a landing folder -> validated table.

A Structured Streaming query with ``trigger(availableNow=True)`` processes
every object that arrived since the last run and stops, so it runs as a
scheduled batch job. Progress (which files were consumed) lives in the
checkpoint folder, which must be on shared storage: a lost executor or a
restarted driver resumes from the last committed batch.

Each micro-batch is read, parsed and written once, to ``{target}/batch_id=N``
with a ``load_state`` folder for ``valid`` and one for ``quarantined`` rows; the
latter name the rules they break in ``violations``. The write overwrites the
batch's own folder, so a batch that is replayed after a failure replaces its
earlier partial output instead of duplicating it (exactly-once results).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators import quality

VALID, QUARANTINED = "valid", "quarantined"


def ingest_text_objects(
    spark: SparkSession,
    landing: str,
    parse: Callable[[DataFrame], DataFrame],
    rules: Sequence[quality.RowRule],
    target: str,
    checkpoint: str,
    max_bytes_per_batch: int = 1 << 40,
    glob: str | None = None,
) -> StreamingQuery:
    """Start the ingestion; call ``awaitTermination()`` on the result.

    ``max_bytes_per_batch`` bounds a micro-batch by the bytes of its files (a
    larger single file is a batch of its own): batches run one after the
    other, so it should fill the cluster for a while."""
    reader = spark.readStream.format("text").option("maxBytesPerTrigger", max_bytes_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parsed = parse(reader.load(landing))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        marked = quality.annotate_violations(batch, rules, "violations")
        state = F.when(F.size("violations") == 0, F.lit(VALID)).otherwise(F.lit(QUARANTINED))
        marked.withColumn("load_state", state).write.mode("overwrite").partitionBy("load_state").parquet(
            f"{target}/batch_id={batch_id}")

    return (
        parsed.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_ingestion(*args, **kwargs) -> None:
    """Run one ``availableNow`` pass to completion."""
    q = ingest_text_objects(*args, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The valid rows of all batches; other folders are not read."""
    return spark.read.parquet(target).filter(F.col("load_state") == VALID).drop("batch_id", "load_state", "violations")


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """The other rows, with ``violations`` and their ``batch_id``."""
    return spark.read.parquet(target).filter(F.col("load_state") == QUARANTINED).drop("load_state")
