"""Helpers shared by the operators: staged tables, appended columns, fold marks.

Every operator keeps the rows of its input and appends columns. An input
column named like an appended one (letter case aside) is dropped first, so the
appended column always wins and no reference is ambiguous.
"""

from __future__ import annotations

import ctypes
import functools
import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import shared_path
from tillroll.sources.tables import read_table

__all__ = ["append_columns", "arrow_schema", "bounded_sample", "complete_groups", "crc_fold", "drop_clashes", "gathered", "numbered",
           "parts_of", "read_table", "slices_by_bytes", "small_batches", "stage", "tidied", "utf8"]


def gathered(df: DataFrame) -> DataFrame:
    """What a shuffle made, in four tasks a core at most: the partitions of small
    intermediate results would be thousands of tiny files."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    A staged table fixes row positions and random order once, cuts lineage and
    survives lost executors, as the folder is shared."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", f"{name}-{time.time_ns():x}", unique=True)
    # small row groups: a writer holds one in memory
    df.write.mode("overwrite").option("parquet.block.size", str(16 << 20)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_clashes(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns named like one of ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def arrow_schema(fields: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def parts_of(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``most`` bytes, so results stay small too."""
    for b in batches:
        step = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for lo in range(0, b.num_rows, step):
            yield b.slice(lo, step)


def small_batches(df: DataFrame) -> None:
    """In this session, Arrow batches of at most 4 MB and 2,000 rows and Parquet
    reader batches of at most 512 rows, so that two tasks of an executor hold
    little of long texts on either side of a Python function. Smaller settings of
    the session are left as they are."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20),
                      ("spark.sql.parquet.columnarReaderBatchSize", 512)):
        now = re.fullmatch(r"(\d+)b?", df.sparkSession.conf.get(key) or "")
        if not now or not 0 < int(now[1]) <= most:
            df.sparkSession.conf.set(key, str(most))


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after whose task the worker gives unused memory back: workers
    stay for later tasks, and an executor has several."""
    @functools.wraps(run)
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return work


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of the (sorted) keys, with group borders."""
    def borders(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            x = t.column(k).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        first = [t.column(k)[0].as_py() for k in keys]
        inside = borders(t)
        cut = int(inside[-1]) if inside.size else 0
        if cut or (held and first != last):
            whole = pa.concat_tables([*held, t.slice(0, cut)]) if held else t.slice(0, cut)
            yield whole, np.concatenate([[0], borders(whole), [whole.num_rows]])
            held = []
        held.append(t.slice(cut))
        last = [t.column(k)[t.num_rows - 1].as_py() for k in keys]
    if held:
        whole = pa.concat_tables(held)
        yield whole, np.concatenate([[0], borders(whole), [whole.num_rows]])


_NUMBERS = T.StructType([T.StructField("_task", T.IntegerType()), T.StructField("_place", T.LongType())])


def append_columns(df: DataFrame, out: T.StructType,
                   work: Callable[[], Callable[[pa.RecordBatch], list]], *,
                   drop: tuple[str, ...] = (), number: bool = False) -> DataFrame:
    """Append the columns ``out`` to ``df``, batch by batch, in one Python pass.

    ``work()`` runs once per task and returns a function from an Arrow batch
    to one array per appended column. ``drop`` names input columns that only
    the function needs. With ``number``, the task number and the row's place
    in its task follow as ``_task`` and ``_place``; stage the result before
    use, as only a written number is the same in every later job."""
    if number:
        inner, out = work, T.StructType([*out.fields, *_NUMBERS.fields])

        def work():
            from pyspark import TaskContext

            each, task, seen = inner(), TaskContext.get().partitionId(), 0

            def numbered(b):
                nonlocal seen
                n, seen = b.num_rows, seen + b.num_rows
                return [*each(b), np.full(n, task, np.int32), np.arange(seen - n, seen)]

            return numbered

    small_batches(df)
    df = drop_clashes(df, out.names)
    kept = drop_clashes(df, list(drop))
    gone = {n.lower() for n in drop}
    stay = [i for i, c in enumerate(df.columns) if c.lower() not in gone]
    fields = T.StructType(list(kept.schema.fields) + list(out.fields))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        extra = [schema.field(i).type for i in range(len(schema) - len(out.fields), len(schema))]
        each = work()
        for b in parts_of(batches):
            new = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=t)
                   for x, t in zip(each(b), extra)]
            cols = [c.cast(f.type) if c.type != f.type else c
                    for c, f in zip([*(b.column(i) for i in stay), *new], schema)]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(
                [pa.field(f.name, f.type) for f in schema]))

    return df.mapInArrow(run, fields)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``_task`` and ``_place`` only."""
    return append_columns(df, T.StructType([]), lambda: lambda b: [], number=True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices_by_bytes(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; one long row is its own range."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def crc_fold(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as ''."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % F.lit(mod)


SAMPLE_BYTES = 256 << 20
_PARTS = 64  # of the texts of one id


def bounded_sample(docs: DataFrame, picks: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text",
                   most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Rows of ``docs`` whose id is in ``picks`` (at most ``most`` rows, so the
    broadcast is bounded), at most ``most`` of them, in id-hash order. Copies (equal
    id and text) count once, and a second text of an id comes after the first
    texts of all ids. The rows end before their texts pass ``most_bytes``; the
    first one always stays."""
    texts = docs.join(F.broadcast(picks), id_col).dropDuplicates([id_col, text_col])
    by_id = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col), text_col)
    order = [F.col("_turn"), F.xxhash64(F.col(id_col)), F.col(id_col), F.xxhash64(text_col), F.col(text_col)]
    # ``most`` texts of an id can be wanted at most: an id of very many is first cut down in parts
    by_part = Window.partitionBy(id_col, F.pmod(F.xxhash64(text_col), F.lit(_PARTS))).orderBy(F.xxhash64(text_col), text_col)
    few = (texts.withColumn("_turn", F.row_number().over(by_part)).filter(F.col("_turn") <= most)
           .withColumn("_turn", F.row_number().over(by_id)).orderBy(*order).limit(most))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    held = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (few.withColumn("_held", F.sum(size).over(held)).filter((F.col("_held") <= most_bytes) | (F.col("_held") == size))
            .drop("_turn", "_held"))
