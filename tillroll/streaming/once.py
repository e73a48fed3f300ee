"""Keyed state across micro-batches: each key is loaded once, late rows are set aside.

The state is a table of the keys seen and their event times, one version per batch.
Batch N reads version N - 1 and writes its rows and version N into folders of its own, so a
replay after a failure finds the same state and replaces what it wrote. The
watermark trails the largest event time of earlier batches by ``delay``. A row
older than it is late: it goes to the ``late`` folder, as its key may have left the state.
Keys older than the new watermark leave the state, which so stays bounded by ``delay``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VALID, LATE, REPEATED = "valid", "late", "repeated"


def load_once(spark: SparkSession, landing: str, parse: Callable[[DataFrame], DataFrame], keys: Sequence[str], at: str,
              delay: str, target: str, checkpoint: str, glob: str | None = None,
              max_bytes_per_batch: int = 1 << 40) -> None:
    """Run one ``availableNow`` pass over new text objects. ``delay`` is an SQL
    interval, such as ``INTERVAL 1 DAY``. Of rows of one key in a batch the earliest
    counts. Rows without a key or time are late."""
    keys = list(keys)
    reader = spark.readStream.format("text").option("maxBytesPerTrigger", max_bytes_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parsed = parse(reader.load(landing))

    def write_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        names = batch.columns
        seen = batch.limit(0).select(*keys, at).withColumn("watermark", F.col(at))
        if number:
            seen = session.read.schema(seen.schema).parquet(f"{target}/state/batch_id={number - 1}")
        mark = seen.agg(F.max("watermark")).first()[0]
        unknown = F.col(at).isNull()
        for k in keys:
            unknown = unknown | F.col(k).isNull()
        late = unknown if mark is None else unknown | (F.col(at) < F.lit(mark))
        # the earliest row of a key, by partial aggregation; ties by content
        whole = F.struct(*names)
        first = (batch.filter(~late).groupBy(*keys)
                 .agg(F.min_by(whole, F.struct(F.col(at), F.xxhash64(*names))).alias("_row"), F.count(F.lit(1)).alias("_n")))
        known = seen.filter(F.col(keys[0]).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_known"))
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & (first[k] == known[f"_k{i}"])
        judged = first.join(known, cond, "left").select("_row.*", "_n", F.col("_known").isNotNull().alias("_known"))
        kept = F.when(F.col("_known"), 0).otherwise(1)
        states = F.array(F.struct(F.lit(VALID).alias("load_state"), kept.cast("bigint").alias("n_rows")),
                         F.struct(F.lit(REPEATED).alias("load_state"), (F.col("_n") - kept).alias("n_rows")))
        out = judged.select(*names, F.inline(states)).filter("n_rows > 0")
        aside = batch.filter(late).select(*names, F.lit(LATE).alias("load_state"), F.lit(1).cast("bigint").alias("n_rows"))
        rows = f"{target}/rows/batch_id={number}"
        out.unionByName(aside).write.mode("overwrite").partitionBy("load_state").parquet(rows)
        # the next state: old and new keys that are not older than the new watermark
        written = session.read.schema(out.schema).parquet(rows)
        added = written.filter(F.col("load_state") == VALID).select(*keys, at)
        newest = written.filter(F.col(at).isNotNull()).agg(F.max(at).alias("m")).select(
            F.greatest(F.col("m") - F.expr(delay), F.lit(mark)).cast(batch.schema[at].dataType).alias("m")).first()[0]
        mark_col = F.lit(newest).cast(batch.schema[at].dataType)
        state = seen.filter(F.col(keys[0]).isNotNull()).select(*keys, at).unionByName(added)
        if newest is not None:
            state = state.filter(F.col(at) >= mark_col)
        # one row without a key carries the watermark
        carrier = session.range(1).select(*[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in (*keys, at)])
        (state.unionByName(carrier).withColumn("watermark", mark_col)
         .write.mode("overwrite").parquet(f"{target}/state/batch_id={number}"))

    query = (parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def rows(spark: SparkSession, target: str, state: str = VALID) -> DataFrame:
    """The rows of one load state of all batches."""
    return spark.read.parquet(f"{target}/rows").filter(F.col("load_state") == state).drop("batch_id", "load_state")
