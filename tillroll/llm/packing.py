"""Packing: concatenate and cut.

Pass one writes, per task, each document's ids with its start in the task, so
the order of the stream is fixed by the written table. The token totals of the
tasks (one number each) are summed up in order, which gives every document its
global offset. Pass two cuts each document's ids at the fixed window borders.
A document across a border becomes several pieces, the records that continue it.
All sequences but the last are full, so there is no other padding.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are packed like any other row; an empty table gives no piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, stage, utf8
from tillroll.llm.tokens import encoder, tokenizer_path


def pack(docs: DataFrame, size: int = 4096, end_id: int = 2, path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids`` (binary,
    little-endian uint32), ``doc_tokens``, ``sequence_id``, ``offset``."""
    path = path or tokenizer_path()
    slim = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    written = stage(append_columns(slim, _FIRST, lambda: _first_pass(path, end_id), drop=("_text",)), "pack")
    # one number per task of the first pass
    totals = sorted((r[0], r[1]) for r in written.groupBy("part").agg(F.max("upto")).collect())
    ends = np.cumsum([n for _, n in totals], dtype=np.int64).tolist()
    bases = docs.sparkSession.createDataFrame(
        [(part, end - n) for (part, n), end in zip(totals, ends)], "part int, base long")
    # second pass: arithmetic and binary slices only
    n = (F.octet_length("ids") / 4).cast("long")
    placed = (written.join(F.broadcast(bases), "part")
              .select(id_col, "ids", n.alias("doc_tokens"), (F.col("base") + F.col("upto") - n).alias("_first")))
    cut = placed.withColumn("sequence_id", F.explode(F.expr(
        f"sequence(_first div {size}L, (_first + doc_tokens - 1L) div {size}L)")))
    start = F.greatest(F.lit(0), F.col("sequence_id") * size - F.col("_first"))
    end = F.least(F.col("doc_tokens"), (F.col("sequence_id") + 1) * size - F.col("_first"))
    cut = cut.withColumns({"start": start.cast("long"), "length": (end - start).cast("long")})
    ids = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    return cut.select(id_col, "start", "length", ids.alias("ids"), "doc_tokens", "sequence_id",
                      (F.col("_first") + F.col("start") - F.col("sequence_id") * size).alias("offset"))


_FIRST = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("part", T.IntegerType()),
                       T.StructField("upto", T.LongType())])


def _first_pass(path: str, end_id: int):
    """Ids of each text, the task number, and the task's tokens up to the row's end."""
    from pyspark import TaskContext

    enc, tail = encoder(path, False), np.array([end_id], "<u4").tobytes()
    task, seen = TaskContext.get().partitionId(), 0

    def each(b):
        nonlocal seen
        ids = [x + tail for x in enc.over(*utf8(b.column(b.schema.get_field_index("_text"))))]
        upto = seen + np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        seen = int(upto[-1]) if len(upto) else seen
        return [pa.array(ids, pa.binary()), np.full(len(ids), task, np.int32), upto]

    return each


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: its ids in order and its pieces; a sequence holds
    at most ``size`` tokens, so the group is bounded."""
    each = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id")
            .agg(each.alias("_p"), F.sum("length").alias("n_tokens"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("_p", F.lit(b"").cast("binary"),
                                lambda a, p: F.concat(a, p["ids"])).alias("ids")))

