"""WARC: write archives with revisit records, read them back by chain.

Writing: pages with equal payloads are found by hash and length; the page with
the smallest id is the response, the others are revisits that refer to it.
Records go to uncompressed WARC files through Spark's text writer, one record
per row, so the files land wherever Spark can write.

Reading: the text reader cuts the files at every ``WARC/1.0`` line, also at
those inside payloads, and splits large files among tasks. Each piece is a
candidate record and gives the offset of its successor, header end plus
Content-Length plus the closing line feeds. Within a split a chain of
candidates is followed at once to where it leaves the split; across splits,
pointer jumping from the start of each file (doubling, so the rounds grow with
the logarithm of the splits) finds where the true chain enters. Only candidates
on that chain are records; the others are payload, and pieces of one record are
joined again.

Defined results: a null payload is empty; equal pages that share the smallest
id are all responses; a page without an id comes back without one; a file whose
chain breaks gives the records up to the break.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import arrow_schema, small_batches, stage

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
_FEW = 100_000  # rows of about 150 bytes that may be broadcast
_MAGIC, _END = MAGIC.encode(), END.encode()
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _escape(text: str) -> str:
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescape(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write_warc(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row below ``path``; payloads of ``least`` bytes or
    more that occur under a smaller id become revisits."""
    small_batches(pages)
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("key"),
                        F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("same", F.sha2(F.encode("payload", "UTF-8"), 256))
    # partial counts per task: a payload of a third of all pages is one row a task
    firsts = (rows.filter(F.octet_length("payload") >= least).groupBy("same")
              .agg(F.min("key").alias("first"), F.count("*").alias("n"))
              .filter("n > 1 AND first IS NOT NULL").select("same", F.col("first").cast("string").alias("first"))
              .withColumnRenamed("same", "with"))
    firsts = stage(firsts, "warc-first")  # a table of its own, so a hot payload's join can be split
    joined = rows.join(firsts, rows["same"] == firsts["with"], "left").select("id", "url", "payload", "first")
    out = T.StructType([T.StructField("value", T.StringType())])
    kind = arrow_schema(out)

    def records(batches):
        for b in batches:
            lines, held = [], 0
            for page, url, text, first in zip(*(c.to_pylist() for c in b.columns)):
                payload = text.encode()
                revisit = first is not None and page != first
                head = [f"{MAGIC}WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {date}"]
                if page is not None:
                    head += [f"WARC-Record-ID: <urn:page:{_escape(page)}>"]
                if url is not None:
                    head += [f"WARC-Target-URI: {_escape(url)}"]
                if revisit:
                    head += [f"WARC-Refers-To: <urn:page:{_escape(first)}>",
                             "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
                head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: text/html",
                         f"Content-Length: {0 if revisit else len(payload)}"]
                lines.append("\r\n".join(head) + END + ("" if revisit else text))
                held += len(lines[-1])
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, kind.field(0).type)], schema=kind)
                    lines, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(lines, kind.field(0).type)], schema=kind)

    joined.mapInArrow(records, out).write.mode("overwrite").option("lineSep", END).text(path)


_PARSED = T.StructType([T.StructField(n, T.StringType()) for n in ("record_type", "id", "url", "refers_to", "digest")]
                       + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType())])


def _parse(body: bytes) -> tuple:
    """Header fields, payload size and digest, and the payload of one record."""
    head, _, rest = body.partition(_END)
    named = {k.strip().lower(): v.strip() for k, v in
             (x.split(":", 1) for x in head.decode("utf-8", "replace").split("\r\n") if ":" in x)}
    urn = lambda n: (_unescape(named[n][len("<urn:page:"):-1]) if n in named else None)
    url, length = named.get("warc-target-uri"), named.get("content-length", "0")
    payload = rest[:int(length)] if length.isdigit() else b""
    return (named.get("warc-type"), urn("warc-record-id"), None if url is None else _unescape(url),
            urn("warc-refers-to"), named.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            len(payload), payload_digest(payload)), payload


def _pieces(spark: SparkSession, path: str, bodies: bool) -> DataFrame:
    """The files cut at every magic line: file, split, place of the piece within
    the split's pieces, its size, and the bytes a record that begins here needs
    (null if none can). With ``bodies`` the piece itself, else the record it is
    if it is a record and complete."""
    lines = (spark.read.option("lineSep", MAGIC).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.col("value").cast("binary").alias("body")))
    fields = T.StructType([*lines.schema.fields[:2]] + [T.StructField(n, T.LongType()) for n in ("at", "size", "need")]
                          + ([T.StructField("body", T.BinaryType())] if bodies else list(_PARSED.fields)))
    kind = arrow_schema(fields)

    def run(batches):
        seen: dict = {}
        for b in batches:
            cols: list[list] = [[] for _ in fields]
            for file, split, body in zip(*(c.to_pylist() for c in b.columns)):
                pos = seen.get((file, split), 0)
                seen[(file, split)] = pos + len(body) + len(_MAGIC)
                end = body.find(_END)
                found = _LENGTH.search(body, 0, end + 2) if end >= 0 else None
                need = end + len(_END) + int(found[1]) + len(_END) if found else None
                complete = need is not None and len(body) >= need
                more = (body,) if bodies else _parse(body)[0] if complete else (None,) * len(_PARSED)
                for c, x in zip(cols, (file, split, pos, len(body), need, *more)):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind)], schema=kind)

    return lines.mapInArrow(run, fields)


def _successors(offset: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Per candidate of one split (by offset), the index of its successor, and
    its own where that is no candidate of the split."""
    at = np.minimum(np.searchsorted(offset, after), len(offset) - 1)
    return np.where(offset[at] == after, at, np.arange(len(offset)))


def _leaves(offset: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Per candidate of one split, the first offset on its chain that is no
    candidate of the split; -1 for a broken one. Pointers jump twice as far each time."""
    to = _successors(offset, after)
    while not np.array_equal(further := to[to], to):
        to = further
    return after[to]


def _reached(offset: np.ndarray, after: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which candidates of one split lie on a chain from an ``entry``."""
    to, real = _successors(offset, after), entry.copy()
    while True:
        real[to[real]] = True  # now those twice as many steps away
        further = to[to]
        if np.array_equal(further, to):
            return real
        to = further


def true_records(chain: DataFrame) -> DataFrame:
    """Of candidates (file, split, offset, after), those reached from offset 0
    of their file, as (file, split, offset, owner): the owner is the record's
    offset for records, and of the record that a rejected piece lies in (null
    if that record began in an earlier split)."""
    leave_fields = T.StructType([*chain.schema.fields, T.StructField("leaves", T.LongType())])

    def leave(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("offset", ignore_index=True)
        return p.assign(leaves=_leaves(p["offset"].to_numpy(np.int64), p["after"].to_numpy(np.int64)))

    # pieces that can be no record lead nowhere; most of a payload of magic lines is such
    some = F.col("after") >= 0
    chain = stage(chain.filter(some).groupBy("file", "split").applyInPandas(leave, leave_fields)
                  .unionByName(chain.filter(~some).withColumn("leaves", F.lit(-1).cast("long"))), "warc-chain")
    # the places where a chain can enter a split: few per split
    doors = chain.select("file", F.col("leaves").alias("offset")).distinct()
    start = chain.filter("offset = 0").select("file", "offset")
    jump = stage(chain.join(doors.union(start).distinct(), ["file", "offset"], "left_semi")
                 .select("file", "offset", "leaves"), "warc-jump")
    reached = stage(start, "warc-reached")
    count = reached.count()
    while True:
        step = jump.withColumnRenamed("leaves", "to")
        reached = stage(reached.union(reached.join(step, ["file", "offset"]).select("file", F.col("to").alias("offset")))
                        .distinct(), "warc-reached")
        now = reached.count()
        if now == count:
            break
        count = now
        ahead = step.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        jump = stage(step.join(ahead, ["file", "to"]).select("file", "offset", F.col("further").alias("leaves")),
                     "warc-jump")
    entered = chain.join(reached.withColumn("entry", F.lit(True)), ["file", "offset"], "left")
    mark_fields = T.StructType([T.StructField("file", T.StringType()), T.StructField("split", T.LongType()),
                                T.StructField("offset", T.LongType()), T.StructField("owner", T.LongType())])

    def mark(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("offset", ignore_index=True)
        offset, after = p["offset"].to_numpy(np.int64), p["after"].to_numpy(np.int64)
        real = _reached(offset, after, p["entry"].eq(True).to_numpy(bool, na_value=False))
        last = np.maximum.accumulate(np.where(real, np.arange(len(real)), -1))
        owner = pd.array(np.where(last >= 0, offset[np.maximum(last, 0)], 0), dtype="Int64")
        owner[last < 0] = pd.NA
        return p[["file", "split", "offset"]].assign(owner=owner)

    marked = stage(entered.select("file", "split", "offset", "after", "entry")
                   .groupBy("file", "split").applyInPandas(mark, mark_fields), "warc-marked")
    # carry the last record of earlier splits into a split's first pieces: one row per split
    by_split = marked.groupBy("file", "split").agg(F.max("owner").alias("latest"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carry = by_split.select("file", "split", F.max("latest").over(before).alias("carried"))
    return (marked.join(carry, ["file", "split"])
            .select("file", "split", "offset", F.coalesce("owner", "carried").alias("owner")))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``: ``file``, ``offset``, ``record_type``, ``id``,
    ``url``, ``refers_to``, ``digest`` (of the header), ``payload_bytes`` and
    ``payload_digest`` of the payload in the record, and the ``payload`` itself.

    Without ``payload``, only the pieces of records that hold a magic line are
    read a second time, and no payload is moved otherwise."""
    small_batches(spark.range(0))
    width = len(_MAGIC)
    pieces = stage(_pieces(spark, path, False), "warc-pieces")
    # a split's pieces start where those of the splits before it end
    sizes = pieces.groupBy("file", "split").agg(F.sum(F.col("size") + F.lit(width)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    placed = stage(pieces.join(base, ["file", "split"])
                   .withColumn("offset", F.col("base") + F.col("at") - width)
                   .filter("offset >= 0").drop("base"), "warc-placed")  # the first piece lies before any magic
    after = F.when(F.col("need").isNull(), F.lit(-1)).otherwise(F.col("offset") + width + F.col("need"))
    marked = true_records(placed.select("file", "split", "offset", after.cast("long").alias("after")))
    owned = placed.join(marked.select("file", "offset", "owner"), ["file", "offset"]).filter("owner IS NOT NULL")
    whole = (F.col("owner") == F.col("offset")) & (F.col("size") >= F.col("need"))
    owned = stage(owned.withColumn("whole", F.coalesce(whole, F.lit(False))), "warc-owned")
    out = T.StructType([T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), *_PARSED.fields]
                       + ([T.StructField("payload", T.BinaryType())] if payload else []))

    def rejoin(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("offset")
        fields, data = _parse(_MAGIC.join(bytes(x) for x in p["body"]))
        row = (p["file"].iloc[0], p["owner"].iloc[0], *fields, *([data] if payload else []))
        return pd.DataFrame([row], columns=out.names)

    again = owned if payload else owned.filter("NOT whole")
    n_again = again.count()
    if not n_again:
        return owned.select(*out.names) if not payload else spark.createDataFrame([], out)
    if n_again <= _FEW:  # counted, so the pieces need not be shuffled to find these
        again = F.broadcast(again)
    bodies = (_pieces(spark, path, True).select("file", "split", "at", "body")
              .join(again.select("file", "split", "at", "offset", "owner"), ["file", "split", "at"]))
    # pieces of one record at most in a group
    rejoined = stage(bodies.groupBy("file", "owner").applyInPandas(rejoin, out), "warc-rejoined")
    return rejoined if payload else owned.filter("whole").select(*out.names).unionByName(rejoined)


def resolve(records: DataFrame) -> DataFrame:
    """Per record: ``record_type``, ``id``, ``refers_to``, and ``payload_bytes``
    and ``payload_digest`` of the full payload. Those of a response are taken
    from its bytes, those of a revisit from the response it refers to."""
    slim = stage(records.select("record_type", "id", "refers_to", "payload_bytes", "payload_digest"), "warc-records")
    responses = slim.filter("record_type = 'response'")
    full = stage(responses.filter("id IS NOT NULL").groupBy(F.col("id").alias("to"))
                 .agg(F.max("payload_bytes").alias("full_bytes"), F.max("payload_digest").alias("full_digest")),
                 "warc-responses")
    revisits = slim.filter("record_type = 'revisit'")
    found = (revisits.join(full, revisits["refers_to"] == full["to"], "left")
             .select("id", "record_type", "refers_to", F.col("full_bytes").alias("payload_bytes"),
                     F.col("full_digest").alias("payload_digest")))
    return responses.select(*found.columns).unionByName(found)
