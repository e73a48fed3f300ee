"""A11 text objects, B13 partitioned backup, and JSON document files.

Spark writes a *directory* of part files per target path (one per task),
committed atomically by the output committer; re-running with
``mode="overwrite"`` replaces the directory, which is what an object store
"put under the same name" means for a distributed writer.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, column: str | Column | None = None, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None, compression: str | None = None) -> str:
    """One line per row. ``column`` (default: the only non-partition column)
    holds the line text."""
    partition_by = list(partition_by or [])
    if column is None:
        value_cols = [c for c in df.columns if c not in partition_by]
        if len(value_cols) != 1:
            raise ValueError("give the text column")
        column = value_cols[0]
    line = F.col(column) if isinstance(column, str) else column
    out = df.select(line.cast("string").alias("value"), *partition_by)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def delimited_line(cols: Sequence[str], sep: str = "|") -> Column:
    """Columns joined into one text line. A percent sign, a line break and the
    separator are written as percent codes and NULL as ``%N``, so
    ``parse_delimited`` gives back the same rows."""
    special = "[" + "".join("\\" + c if c not in "\r\n" else c for c in _escaped(sep)) + "]"

    def field(c: str) -> Column:
        plain = text = F.col(c).cast("string")
        for char in _escaped(sep):
            text = F.replace(text, F.lit(char), F.lit(_code(char)))
        return F.coalesce(F.when(plain.rlike(special), text).otherwise(plain), F.lit(_NULL))

    return F.concat_ws(sep, *[field(c) for c in cols])


def parse_delimited(raw: DataFrame, fields: Sequence[tuple[str, str]], sep: str = "|", checked: bool = False) -> DataFrame:
    """Lines (column ``value``) written by ``delimited_line`` as typed columns
    ``(name, type)``. A missing field, or text that is not of its type, is NULL.

    ``checked`` keeps what would be lost: ``line`` (the raw text), ``n_fields``, and
    ``bad_types`` (the fields whose text is not of their type), for
    ``quality.line_rules``."""
    parts = F.split("value", re.escape(sep))

    def text(i: int) -> Column:
        raw_text = F.get(parts, i)
        out = raw_text
        for char in reversed(_escaped(sep)):  # the percent sign last
            out = F.replace(out, F.lit(_code(char)), F.lit(char))
        # most fields hold no code
        return F.when(raw_text != _NULL, F.when(raw_text.contains("%"), out).otherwise(raw_text))

    typed = [text(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]
    if not checked:
        return raw.select(*typed)
    bad = F.array(*[F.when(text(i).isNotNull() & text(i).try_cast(kind).isNull(), F.lit(name))
                    for i, (name, kind) in enumerate(fields)])
    return raw.select(*typed, F.col("value").alias("line"), F.size(parts).alias("n_fields"),
                      F.filter(bad, lambda x: x.isNotNull()).alias("bad_types"))


_NULL = "%N"


def _escaped(sep: str) -> list[str]:
    if len(sep) != 1 or sep in "%\r\n0123456789ABCDEFN":
        raise ValueError(f"not a separator: {sep!r}")
    return ["%", "\n", "\r", sep]


def _code(char: str) -> str:
    return f"%{ord(char):02X}"


def backup(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Parquet copy, partitioned so later reads prune directories."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _fingerprint_aggs(df: DataFrame) -> list[Column]:
    cols = sorted(df.columns)
    # the hash skips NULLs, so each column's null flag is hashed as well
    h = F.xxhash64(*[x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    return [F.count(F.lit(1)).alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum")]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: ``(rows, hash_sum)`` where ``hash_sum`` is the order-free sum
    of per-row 64-bit hashes over all columns, in column-name order. Two
    frames with equal multisets of rows have equal fingerprints."""
    return df.agg(*_fingerprint_aggs(df))


def observed_fingerprint(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its fingerprint collected *while* an action runs on it
    (``DataFrame.observe``), so writing a copy and fingerprinting the
    source is one pass over the source, not two. Read the result with
    ``observation.get`` after the action."""
    obs = Observation("fingerprint")
    return df.observe(obs, *_fingerprint_aggs(df)), obs


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Compare fingerprints (two distributed aggregates, one row each)."""
    fa, fb = fingerprint(a).first(), fingerprint(b).first()
    return (fa["rows"], fa["hash_sum"]) == (fb["rows"], fb["hash_sum"])


def write_json_lines(docs: DataFrame, path: str, max_records_per_file: int = 1_000_000, mode: str = "overwrite",
                     compression: str | None = None) -> str:
    """One document a line (NDJSON): the form for large sets. No shuffle, every
    task streams its own documents into part files of at most
    ``max_records_per_file``, and readers can split the files."""
    w = docs.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def write_json_documents(docs: DataFrame, path: str, file_col: str, mode: str = "overwrite",
                         pretty: bool = True) -> str:
    """Exchange files for readers that want one JSON value a file: each file is
    one JSON array of the documents sharing ``file_col``, all files in one
    folder. An array is one text cell, so callers choose ``file_col`` for a
    bounded number of bounded documents; large sets go to ``write_json_lines``."""
    payload = [c for c in docs.columns if c != file_col]
    opts = {"pretty": "true"} if pretty else {}
    files = docs.groupBy(file_col).agg(
        F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in payload])), opts).alias("value")
    ).select("value")
    files.write.mode(mode).option("maxRecordsPerFile", 1).text(path)
    return path
