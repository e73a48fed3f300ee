"""Benchmark decontamination: a broadcast hash set of normalised n-grams.

Words are runs of ASCII letters and digits and of non-ASCII characters, with
A-Z folded. A window is ``n`` consecutive words of a benchmark item; an item of
fewer words is one window. Each task scans the windows of its texts against
the hash set, verifies every hash hit against the window's own words, and marks
the words inside verified windows.

The broadcast is bounded: what the windows take in memory is summed up first, and
a benchmark above ``block_bytes`` is dealt into blocks of about that size, long items
in parts that share ``n - 1`` words. Every block is then one more pass over the
documents, so the result does not depend on the number of blocks.

Defined results: a null or wordless text has no words and no hits; an item
without words matches nothing; items that share an id count once; windows of an
item with a null id mark words but name no item; repeated document rows each
get their own row; input columns named like an appended one are replaced.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, slices_by_bytes, stage, utf8
from tillroll.llm.textvec import ALNUM, runs_of, scan_words

OUT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),  # words inside any occurrence
    T.StructField("hit_runs", T.ArrayType(T.LongType())),  # word ranges: start, end, start, end ...
    T.StructField("hit_bytes", T.ArrayType(T.LongType())),  # the same ranges as UTF-8 offsets
    T.StructField("hit_items", T.ArrayType(T.StringType())),  # sorted as strings
])
_SLICE = 2 << 20
_BITS = 20
_WINDOW = 36  # bytes of a window's code, place and items
_PART = 1 << 20  # bytes of an item that are kept together


class NgramSet:
    """The windows of one benchmark block, by length: sorted codes, each with its
    place in one text of all normalised words and with the items that hold it.
    About ``_WINDOW`` bytes a window, beside the words themselves."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int) -> None:
        self.n = n
        self.names = [name for name, _ in items]
        parts: dict[int, list] = defaultdict(list)
        texts, held = [], 0
        for number, (_, text) in enumerate(items):
            raw, at = utf8(pa.array([text], pa.string()))
            words = scan_words(raw, at, ALNUM)
            size = min(n, len(words.code))
            if not size:
                continue
            low = raw.tobytes().lower()  # ASCII only, as bytes
            texts.append(b" ".join(low[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())) + b" ")
            end = np.cumsum(words.end - words.start + 1) - 1 + held
            start = end - (words.end - words.start)
            code = runs_of(words.code, size)
            parts[size].append((code, start[:len(code)], end[size - 1:], np.full(len(code), number)))
            held += len(texts[-1])
        self.text = b"".join(texts)
        self.windows: dict[int, tuple[np.ndarray, ...]] = {}
        for size, several in parts.items():
            code, start, end, item = (np.concatenate(x) for x in zip(*several))
            order = np.lexsort((item, code))
            code, start, end, item = code[order], start[order], (end - start)[order], item[order]
            new = np.ones(len(code), bool)  # equal words share an entry
            new[1:] = code[1:] != code[:-1]
            for i in np.flatnonzero(~new).tolist():
                new[i] = self._bytes(start[i], end[i]) != self._bytes(start[i - 1], end[i - 1])
            first = np.flatnonzero(new)
            self.windows[size] = (code[first], start[first], end[first].astype(np.int32),
                                  np.append(first, len(code)), item.astype(np.int32))

    def _bytes(self, start, length) -> bytes:
        return self.text[int(start):int(start) + int(length)]

    def items_of(self, size: int, at: int, words: bytes) -> list | None:
        """Items with these words, if the window at place ``at``, or one of equal code behind it, is them."""
        codes, start, length, border, item = self.windows[size]
        code = codes[at]
        while at < len(codes) and codes[at] == code:
            if self._bytes(start[at], length[at]) == words:
                return [self.names[i] for i in item[border[at]:border[at + 1]].tolist()]
            at += 1
        return None

    def tables(self) -> dict[int, np.ndarray]:
        """Per length, a fixed-size table that most windows fail."""
        out = {}
        for k, (codes, *_) in self.windows.items():
            out[k] = np.zeros(1 << _BITS, bool)
            out[k][(codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        return out


def _ranges(covered: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of True, interleaved."""
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edge)


def _scan(grams: NgramSet, tables, raw, offsets, old) -> tuple[list, ...]:
    words = scan_words(raw, offsets, ALNUM)
    total, n_texts = len(words.code), len(offsets) - 1
    change = np.zeros(total + 1, np.int64)
    items: dict[int, set] = defaultdict(set)
    for size, (codes, *_) in grams.windows.items():
        seen = runs_of(words.code, size)
        maybe = np.flatnonzero(tables[size][(seen >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not maybe.size:
            continue
        got = np.minimum(np.searchsorted(codes, seen[maybe]), len(codes) - 1)
        same = codes[got] == seen[maybe]
        maybe, got = maybe[same], got[same]
        text = np.searchsorted(words.first, maybe, side="right") - 1
        inside = maybe + size <= words.first[text + 1]
        for i, t, g in zip(maybe[inside].tolist(), text[inside].tolist(), got[inside].tolist()):
            a, b = int(words.start[i]), int(words.end[i + size - 1])
            local = raw[a:b].tobytes().lower()
            parts = [local[s - a:e - a] for s, e in zip(words.start[i:i + size].tolist(),
                                                        words.end[i:i + size].tolist())]
            found = grams.items_of(size, g, b" ".join(parts))
            if found is not None:
                change[i] += 1
                change[i + size] -= 1
                items[t].update(x for x in found if x is not None)
    covered = np.cumsum(change[:-1]) > 0
    n_words, n_hit, runs, spans, names = [], [], [], [], []
    for t in range(n_texts):
        lo, hi = int(words.first[t]), int(words.first[t + 1])
        n_words.append(hi - lo)
        was_runs, was_items = old(t)
        if t not in items and not was_runs and not covered[lo:hi].any():
            n_hit.append(0)
            runs.append([])
            spans.append([])
            names.append(was_items)
            continue
        own = covered[lo:hi].copy()
        for a, b in zip(was_runs[::2], was_runs[1::2]):
            own[a:b] = True
        r = _ranges(own)
        n_hit.append(int(own.sum()))
        runs.append(r.tolist())
        base = int(offsets[t])
        at = np.empty_like(r)
        at[::2] = words.start[lo + r[::2]] - base
        at[1::2] = words.end[lo + r[1::2] - 1] - base
        spans.append(at.tolist())
        names.append(sorted(items[t].union(was_items)))
    return n_words, n_hit, runs, spans, names


def _pass(docs: DataFrame, grams: NgramSet, text_col: str, again: bool) -> DataFrame:
    """One scan; ``again`` merges with the columns of an earlier pass."""
    names = {c.lower(): i for i, c in enumerate(docs.columns)}
    text_at = names[text_col.lower()]
    shared = docs.sparkSession.sparkContext.broadcast(grams)
    frame = docs
    if again:  # earlier results travel under names of their own
        frame = docs.withColumnsRenamed({"hit_runs": "_hit_runs", "hit_items": "_hit_items"})
    text_name = frame.columns[text_at]

    def work():
        ngrams = shared.value
        tables = ngrams.tables()

        def each(b: pa.RecordBatch) -> list:
            raw, offsets = utf8(b.column(b.schema.get_field_index(text_name)))
            was = ((b.column(b.schema.get_field_index("_hit_runs")).to_pylist(),
                    b.column(b.schema.get_field_index("_hit_items")).to_pylist())
                   if again else None)
            out: tuple[list, ...] = ([], [], [], [], [])
            for lo, hi in slices_by_bytes(offsets, _SLICE):
                part = offsets[lo:hi + 1]
                old = (lambda t, lo=lo: (was[0][lo + t], was[1][lo + t])) if was else (lambda t: ([], []))
                for col, more in zip(out, _scan(ngrams, tables, raw[part[0]:part[-1]], part - part[0], old)):
                    col.extend(more)
            return list(out)

        return each

    done = append_columns(frame, OUT, work)
    return done.drop("_hit_runs", "_hit_items") if again else done


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, n: int = 10, *, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   block_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_runs``, ``hit_bytes`` and ``hit_items``.

    Map-only over the documents: no shuffle, and no row leaves its task."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("words"))
    parts = append_columns(items, T.StructType([T.StructField("parts", T.ArrayType(T.StringType()))]), _parts(n, "words"))
    parts = parts.select("item", F.explode("parts").alias("words")).distinct()
    # one window at most for each word, of two bytes at least with the gap behind it
    cost = F.octet_length("words") + F.lit(_WINDOW) * F.size(F.split("words", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    parts = stage(parts.withColumn("cost", cost.cast("long")), "benchmark")
    blocks = max(1, -(-int(parts.agg(F.sum("cost")).first()[0] or 0) // block_bytes))
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    out = docs
    for k in range(blocks):
        # about block_bytes at most: the total is known, and parts, each below _PART, are dealt by hash
        rows = dealt.filter(F.col("block") == k).select("item", "words").collect()
        out = _pass(out, NgramSet([(r[0], r[1]) for r in rows], n), text_col, again=k > 0)
    return out


def _parts(n: int, column: str, most: int = _PART):
    """Per text, itself or, if it is long, parts that share n - 1 words, so that
    they have the same windows."""
    def cut(text: str | None) -> list[str]:
        raw, at = utf8(pa.array([text], pa.string()))
        if len(raw) <= most:
            return [text or ""]
        words, out, first = scan_words(raw, at, ALNUM), [], 0
        total = len(words.code)
        while True:
            last = int(np.searchsorted(words.end, words.start[first] + most, side="right")) if total else 0
            last = max(last, first + 2 * n)
            if last + n > total:
                out.append(raw[words.start[first] if total else 0:].tobytes().decode())
                return out
            out.append(raw[words.start[first]:words.end[last - 1]].tobytes().decode())
            first = last - n + 1

    return lambda: lambda b: [[cut(t) for t in b.column(b.schema.get_field_index(column)).to_pylist()]]


def _cut(text: str | None, spans: list[int]) -> str | None:
    if text is None or not spans:
        return text
    raw, pos, kept = text.encode(), 0, []
    for a, b in zip(spans[::2], spans[1::2]):
        kept.append(raw[pos:a])
        pos = b
    kept.append(raw[pos:])
    return b"".join(kept).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, action: str = "document",
                  **columns) -> DataFrame:
    """``docs`` without contaminated rows (``action="document"``) or with the
    hit words cut out of their texts (``action="span"``); same columns."""
    text_col = columns.get("text_col", "text")
    marked = scan_benchmark(docs, benchmark, n, **columns)
    if action == "document":
        return marked.filter(F.size("hit_runs") == 0).drop(*OUT.names)
    if action != "span":
        raise ValueError(f"unknown action {action!r}")

    def work():
        def each(b):
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            return [[_cut(t, s) for t, s in zip(texts, b.column(b.schema.get_field_index("hit_bytes")).to_pylist())]]

        return each

    clean = append_columns(marked, T.StructType([T.StructField("_clean", T.StringType())]), work)
    return clean.withColumn(text_col, F.col("_clean")).drop("_clean", *OUT.names)
