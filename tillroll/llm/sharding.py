"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised at their quantiles, a row's cell gets
its place on the Hilbert curve, rows are sorted by that place, and the sorted
run is cut into shards. Neighbours on the curve are near in every dimension, so
each shard covers a small range of each, and readers can skip shards by the
minimum and maximum of any dimension.

Law ``rows``: with N rows and S shards, row r of the run goes to shard
floor(r * S / N), so counts are at most one apart whatever the keys hold.

Texts are cut by their whole value.

Defined results: a null dimension sorts first; ties on the curve are ordered by
id, then by place in the input, so repeated rows get places of their own; an
empty table gives no rows; extra columns are only kept on request.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, numbered, stage

BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (n x d), d * bits <= 62.

    Works on the bits of all rows at once: undo the rotations and reflections
    from the highest bit down, take the Gray code, and interleave."""
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    high = 1 << (bits - 1)
    q = high
    while q > 1:
        low = q - 1
        for i in range(d):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = high
    while q > 1:
        flip ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _number(column: pa.Array) -> np.ndarray:
    """A double that keeps the column's order; -inf for null."""
    if pa.types.is_boolean(column.type):
        column = column.cast(pa.int8())
    out = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    return np.where(np.isnan(out), -np.inf, out)


def _text_cuts(values: DataFrame, column: str, parts: int) -> list[str]:
    """The values at which a text column is cut into ``parts`` of equal rows, by
    whole value: counts per value, summed in order of the values."""
    counts = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    run = stage(numbered(counts.repartitionByRange("value").sortWithinPartitions("value")), "hilbert-values")
    sums = sorted((r[0], r[1]) for r in run.groupBy("_task").agg(F.sum("n")).collect())
    total, base, seen = sum(n for _, n in sums), [], 0
    for part, n in sums:
        base.append((part, seen))
        seen += n
    starts = values.sparkSession.createDataFrame(base, "_task int, _base long")
    upto = F.col("_base") + F.sum("n").over(Window.partitionBy("_task").orderBy("_place"))
    # a cut is the first value that reaches one of the steps i * total / parts
    step = lambda c: F.least(F.floor(c * F.lit(parts) / F.lit(max(1, total))), F.lit(parts - 1))
    found = (run.join(F.broadcast(starts), "_task").withColumn("upto", upto)
             .filter(step(F.col("upto")) > step(F.col("upto") - F.col("n"))).select("value"))
    return sorted(r[0] for r in found.collect())


def hilbert_shards(rows: DataFrame, dims: list[str], shards: int = 40, id_col: str = "doc_id",
                   bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve`` (place on the curve), ``shard`` and ``slot``.

    ``rows`` should hold only what is needed: it is written three times, with
    its numbers, with its places and in curve order."""
    spark = rows.sparkSession
    keys = [f"_key{i}" for i in range(len(dims))]
    texts = {k for k, c in zip(keys, dims) if isinstance(rows.schema[c].dataType, T.StringType)}
    out = T.StructType([T.StructField(k, T.StringType() if k in texts else T.DoubleType()) for k in keys])

    def numbers():
        return lambda b: [x if k in texts else _number(x)
                          for k, x in ((k, b.column(b.schema.get_field_index(c))) for k, c in zip(keys, dims))]

    # dates and times as numbers
    dated = {c: F.unix_date(c) if isinstance(rows.schema[c].dataType, T.DateType) else F.unix_micros(F.col(c).cast("timestamp"))
             for c in dims if isinstance(rows.schema[c].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))}
    own = {c: f"_dim{i}" for i, c in enumerate(dated)}
    rows = rows.withColumns({own[c]: x for c, x in dated.items()})
    dims = [own.get(c, c) for c in dims]
    keyed = stage(append_columns(rows, out, numbers, drop=tuple(own.values()), number=True), "hilbert-keys")
    # quantiles, numbers by sketch: 2**bits - 1 values per dimension reach the driver
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    plain = [k for k in keys if k not in texts]
    cut_row = (keyed.agg(*[F.percentile_approx(F.when(F.col(k) > float("-inf"), F.col(k)), steps, 10_000).alias(k)
                           for k in plain]).first() if plain else {})
    cuts = {k: np.unique(np.array(cut_row[k] if cut_row[k] is not None else [], float)) for k in plain}
    cuts |= {k: _text_cuts(keyed, k, 1 << bits) for k in keys if k in texts}

    def cell(k, column):
        if k in texts:  # null sorts first
            return np.array([0 if t is None else bisect_right(cuts[k], t) for t in column.to_pylist()], np.int64)
        return np.searchsorted(cuts[k], column.to_numpy(), side="right")

    def curve():
        def each(b):
            cells = np.stack([cell(k, b.column(b.schema.get_field_index(k))) for k in keys], axis=1)
            return [hilbert_index(cells, bits)]

        return each

    # staged, as the range partitioning reads its input twice
    placed = stage(append_columns(keyed, T.StructType([T.StructField("curve", T.LongType())]), curve, drop=tuple(keys)),
                   "hilbert-placed")
    order = ["curve", id_col, "_task", "_place"]
    run = stage(numbered(placed.repartitionByRange(*order).sortWithinPartitions(*order)
                         .drop("_task", "_place")), "hilbert-run")
    # one count per task
    counts = sorted((r[0], r[1]) for r in run.groupBy("_task").agg(F.count("*")).collect())
    total = sum(n for _, n in counts)
    base, seen = [], 0
    for part, n in counts:
        base.append((part, seen))
        seen += n
    starts = spark.createDataFrame(base, "_task int, _base long")
    rank = F.col("_base") + F.col("_place")
    shard = F.expr(f"cast((_base + _place) * {shards}L div {max(1, total)}L as int)")
    return (run.join(F.broadcast(starts), "_task")
            .withColumn("shard", shard)
            # the first row of shard k is row ceil(k * N / S)
            .withColumn("slot", rank - F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L"))
            .drop("_task", "_place", "_base"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in curve order, so that readers prune by
    shard folder and by the row groups' minimum and maximum."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))
