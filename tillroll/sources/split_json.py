"""B1: array files read in many tasks.

A pretty-printed or one-line array file cannot be parsed from its middle: whether a
bracket counts depends on the quotes before it. But what a piece of text does to that state can be
said for every state it may be entered in. Quotes flip it, so only their number
counts; brackets add up once it is known which of them stand in strings.

The files are read in splits, in pieces that end at a closing brace (every object has one), and
twice. First, one row per split says what it does to either state: how many quotes it holds, and how
much deeper it leads if it is entered outside or inside a string. Sums over the splits before it say in
which state a split is entered. Then each split is read from that state. A comma on depth one outside
strings ends an element. Elements inside a split are parsed there; only the ends of splits meet again,
so elements may cross splits. No task holds more than a batch of pieces or an element. A brace stands
for the file's end, too, so the depth behind the array is -1.

The text is neither shuffled nor copied to disk: what is kept is one row per split, the parsed
elements, and the text of the splits' ends.

A file is an array of objects or arrays. An empty array or file has no element; a
malformed element, or a file that does not end where its array does, fails the read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import DROP_SHUFFLES, settings, shared_path
from tillroll.sinks import tables


# the functions that tasks run are sent to them whole: the workers need not find this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TEXT_BYTES = 32 << 20  # text of a scan task
_SPLIT = ["file", "split"]
_BEFORE = (Window.unboundedPreceding, -1)
_QUOTE, _OPEN, _CLOSE, _COMMA = 1, 2, 3, 4


def _partitions(spark: SparkSession, path: str) -> int:
    """Tasks for the text below ``path``, by the files' sizes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    key = F.xxhash64("_metadata.file_path")
    found = files.agg(F.sum("length").alias("total"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("keys")).first()
    if found["keys"] != found["n"]:
        raise ValueError("two file names of one hash")  # files are told apart by it below
    # a task reads many splits, one after the other
    return max(4 * spark.sparkContext.defaultParallelism, (found["total"] or 0) // _TEXT_BYTES)


def _sum_before(value: str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(*_BEFORE)), F.lit(0).cast("bigint"))


def _pieces(spark: SparkSession, path: str, parts: int) -> DataFrame:
    """(file, split, piece), the pieces of a split in one task and in file order."""
    lines = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.col("value").alias("piece")).coalesce(parts)


def _runs(batch) -> Iterator[tuple]:
    """The parts of a batch of pieces that are of one split: the row it begins with, its text, and the places and kinds
    of its quotes, brackets and commas, without those that are escaped."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = batch.num_rows
    if not n:
        return
    none, brace = pa.scalar(b"", pa.large_binary()), pa.scalar(b"}", pa.large_binary())
    texts = pc.binary_join_element_wise(batch.column("piece").cast(pa.large_binary()), none, brace)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[:n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[:offsets[-1]]
    kinds = np.zeros(256, np.uint8)
    for kind, chars in ((_QUOTE, b'"'), (_OPEN, b"[{"), (_CLOSE, b"]}"), (_COMMA, b",")):
        kinds[list(chars)] = kind
    kind = kinds[data]
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):
        # what follows an odd number of backslashes is escaped; the text ends at a brace
        begins = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(begins, append=len(slashes))
        kind[(slashes[begins] + lengths)[lengths % 2 == 1]] = 0
    at = np.flatnonzero(kind != 0)
    kind = kind[at]
    file, split = (batch.column(c).to_numpy() for c in _SPLIT)
    others = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
    rows = [0, *others.tolist(), n]
    for a, b in zip(rows[:-1], rows[1:]):
        i, j = np.searchsorted(at, (offsets[a], offsets[b]))
        yield a, data[offsets[a]:offsets[b]], at[i:j] - offsets[a], kind[i:j]


def _split_effects(batches) -> Iterator:
    """(file, split, quotes, outside, inside) of each split: its quotes, and how much deeper it leads if it is entered
    outside or inside a string."""
    import numpy as np
    import pyarrow as pa

    found: list[tuple] = []
    for batch in batches:
        file, split = (batch.column(c) for c in _SPLIT)
        for row, _, _, kind in _runs(batch):
            key = (file[row].as_py(), split[row].as_py())
            if not found or found[-1][:2] != key:
                found.append((*key, 0, 0, 0))
            *_, quotes, outside, inside = found[-1]
            odd = (np.cumsum(kind == _QUOTE) + quotes) % 2
            step = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
            deeper = int(step[odd == 1].sum())
            found[-1] = (*key, quotes + np.count_nonzero(kind == _QUOTE), outside + int(step.sum()) - deeper, inside + deeper)
    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(5)],
                                     [*_SPLIT, "quotes", "outside", "inside"])


def _elements(batches) -> Iterator:
    """The elements of each split, and of those that it may share with others (``whole`` is false) the part in it: the depth
    on which the part begins, how much deeper it leads, and whether the element ends in it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [*_SPLIT, "element", "first_depth", "depth", "ends"]
    cut, whole = [], []  # rows of names and text; arrays of texts

    def out():
        texts = pa.concat_arrays([*whole, pa.array([c[-1] for c in cut], pa.large_binary())])
        n = len(texts) - len(cut)
        columns = [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([c[i] for c in cut], pa.int64())]) for i in range(len(names))]
        is_whole = pa.array(np.arange(len(texts)) < n)
        texts = texts.cast(pa.binary())
        # bytes that are no UTF-8 stay as they are
        texts = pa.StringArray.from_buffers(len(texts), texts.buffers()[1], texts.buffers()[2])
        cut.clear()
        whole.clear()
        return pa.RecordBatch.from_arrays([*columns, texts, is_whole], [*names, "text", "whole"])

    key, held = None, []
    for batch in batches:
        file, split, state = (batch.column(c) for c in (*_SPLIT, "state"))
        for row, data, at, kind in _runs(batch):
            if key != (file[row].as_py(), split[row].as_py()):
                if held:
                    cut.append((*key, element, begun, depth - begun, 0, b"".join(held)[:-1]))
                key = (file[row].as_py(), split[row].as_py())
                if state[row].as_py() is None:
                    raise ValueError("the splits changed between two reads")
                depth, odd = divmod(state[row].as_py(), 2)
                element, held, begun = 0, [], depth
            quotes = np.cumsum(kind == _QUOTE) + odd
            step = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
            deep = np.cumsum(np.where(quotes % 2 == 0, step, 0)) + depth
            odd, depth = int(quotes[-1]) % 2, int(deep[-1])
            behind = at[(kind == _COMMA) & (quotes % 2 == 0) & (deep == 1)] + 1  # the commas that end elements
            if len(behind):
                text = b"".join([*held, data[:behind[0]].tobytes()])[:-1]
                if element:
                    whole.append(pa.array([text], pa.large_binary()))
                else:
                    cut.append((*key, element, begun, 1 - begun, 1, text))
                # those from the first comma to the last one, without their own
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(behind) - 1, [None, pa.py_buffer(behind), pa.py_buffer(data)])
                whole.append(pc.binary_slice(texts, 0, -1))
                element, held, begun = element + len(behind), [], 1
            # there is a brace behind the last comma
            held.append(data[behind[-1] if len(behind) else 0:].tobytes())
        if cut or whole:
            yield out()
    if held:
        cut.append((*key, element, begun, depth - begun, 0, b"".join(held)[:-1]))
        yield out()


def _entered(splits: DataFrame) -> DataFrame:
    """(file, split, state) of each split: twice the depth on which it is entered, and one if that is in a string."""
    earlier = Window.partitionBy("file").orderBy("split")
    splits = splits.withColumn("in_string", _sum_before("quotes", earlier) % 2)
    splits = splits.withColumn("deeper", F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside")))
    return splits.select(*_SPLIT, (_sum_before("deeper", earlier) * 2 + F.col("in_string")).alias("state"))


def _parsed(text: Column, schema: StructType) -> Column:
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def read_json_array(spark: SparkSession, path: str, schema: StructType, split_bytes: int | None = None) -> DataFrame:
    """One row per element of the array files below ``path``."""
    parts = _partitions(spark, path)
    # both reads have the same splits
    with settings(spark, {"spark.sql.files.maxPartitionBytes": str(split_bytes)} if split_bytes else {}):
        pieces = _pieces(spark, path, parts)
        splits = pieces.mapInArrow(_split_effects, "file long, split long, quotes long, outside long, inside long")
        splits = spark.read.schema(splits.schema).parquet(tables.stage(splits, "json-splits"))
        # one row a split: always small beside the text, which stays in its order
        found = pieces.join(F.broadcast(_entered(splits)), _SPLIT, "left").mapInArrow(
            _elements, "file long, split long, element long, first_depth long, depth long, ends long, text string, whole boolean")
        found = found.withColumn("e", F.when(F.col("whole"), _trimmed(F.col("text")))).filter("NOT whole OR e <> ''")
        found = found.select(*_SPLIT, "element", "first_depth", "depth", "ends", "whole", F.when(~F.col("whole"), F.col("text")).alias("text"),
                             F.when(F.col("whole"), _parsed(F.col("e"), schema)).alias("e"))
        found = spark.read.schema(found.schema).parquet(tables.stage(found, "json-elements", compression="zstd"))
    # at most two parts of a split meet those of the splits beside it
    cut = found.filter(~F.col("whole"))
    cut = cut.withColumn("of", _sum_before("ends", Window.partitionBy("file").orderBy("split", "element")))
    met = cut.groupBy("file", "of").agg(F.collect_list(F.struct("split", "element", "text")).alias("parts"),
                                        F.min("first_depth").alias("first_depth"), F.sum("depth").alias("depth"))
    text = F.array_join(F.transform(F.sort_array("parts"), lambda p: p["text"]), "}")
    # the first element carries the opening bracket, the last one the closing bracket
    text = F.when(F.col("first_depth") == 0, F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    net = F.col("depth") - F.when(F.col("first_depth") == 0, 1).otherwise(0)
    text = F.when(net == -2, F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    met = met.select(_trimmed(text).alias("text")).filter("text <> ''").select(_parsed(F.col("text"), schema).alias("e"))
    return found.filter("whole").select("e").unionByName(met).select("e.*")


_NO_NAME = "__HIVE_DEFAULT_PARTITION__"  # the folder of documents without one


def write_json_arrays(df: DataFrame, path: str, file_col: str) -> str:
    """One array file per value of ``file_col``, each written by one task from a
    stream of its documents, pretty-printed, without holding them together. The
    caller bounds the documents of a value.

    The documents are dealt to the files as columns, in a bucketed table, before any text is made of them:
    what the plan of ``df`` has shuffled leaves the disk before the text comes, and the text itself
    is neither shuffled nor sorted. The table is emptied when the text is written."""
    spark = df.sparkSession
    buckets = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    file = F.col(file_col).cast("string")
    rows = df.select(F.when(file != "", file).otherwise(_NO_NAME).alias("file"), F.struct(*[F.col(c) for c in df.columns if c != file_col]).alias("doc"))
    location = shared_path(spark, "tables", "json-arrays", unique=True)
    name = "json_arrays_" + location.rsplit("-", 1)[1]
    with settings(spark, DROP_SHUFFLES):
        (rows.repartition(buckets, "file").write.bucketBy(buckets, "file")
         .option("path", location).option("compression", "zstd").saveAsTable(name))
    dealt = spark.table(name).withColumn("at", F.monotonically_increasing_id())
    # the first document of a file opens the array, the last one closes it
    order = Window.partitionBy("file").orderBy("at")
    body = dealt.select("file", "at", "doc", F.lag(F.lit(1)).over(order).isNull().alias("first"), F.lead(F.lit(1)).over(order).isNull().alias("last"))
    # never NULL: so the writer takes this order, and does not sort the text by file once more, which keeps no order in a file
    body = body.withColumn("file", F.coalesce("file", F.lit(_NO_NAME))).sortWithinPartitions("file", "at")
    text = F.to_json("doc", {"pretty": "true"})
    value = F.concat(F.when(F.col("first"), "[\n").otherwise(","), text, F.when(F.col("last"), "\n]").otherwise(""))
    body.select(value.alias("value"), "file").write.mode("overwrite").partitionBy("file").text(path)
    spark.sql(f"DROP TABLE {name}")  # the name; the files go with the next line, as nothing reads them any more
    spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(location)
    return path
