"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least ``least``
periods that no neighbouring word extends. For every power of two L, the
dictionary names the factors of L words: a name of 2L words is the pair of the
names of its halves, so equal names are equal words, exactly. A factor that does
not recur in its document cannot be part of a longer one that does, so it leaves
the dictionary, and higher levels hold only what repeats.

Successive occurrences of a factor at a distance q with L/2 < q <= L lie in a
stretch of at most twice the length of the factor, and form arithmetic progressions.
A chain of neighbouring factors with one distance q proposes the period q for the
words that it covers: in a run of four periods the chain is whole and has at least
3q - L + 1 factors, and no smaller distance occurs in it, so q is the smallest
period. Proposals are extended on the words to both sides and deduplicated.

Texts are worked off in slices of some bytes; a document is never cut. Nothing
is shuffled.

Defined results: null, empty and wordless texts have no words and no run;
repeated rows and ids are judged row by row; columns named like the appended
ones give way to them.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, slices_by_bytes, utf8

_SLICE = 1 << 20
RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                    T.StructField("period", T.LongType())])


def _proposals(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(position, factors, L, period) of every chain of factors that is long
    enough for a run of four periods. ``code``: word numbers of all documents;
    ``first``: where each document starts, and the end."""
    size = np.diff(first)
    of = np.repeat(np.arange(len(size)), size)
    end = first[1:][of]
    at = np.arange(len(code))
    name = of * np.int64(len(code) + 1) + code
    out, length = [], 1
    longest = int(size.max()) if len(size) else 0
    while at.size and 2 * length <= max(longest, 2):
        order = np.argsort(name, kind="stable")  # by name, then position
        p, n = at[order], name[order]
        same = n[1:] == n[:-1]
        step = np.diff(p)
        hit = np.flatnonzero(same & (step <= length) & (2 * step > length))
        if hit.size:
            by_place = np.argsort(p[hit], kind="stable")
            i, q = p[hit][by_place], step[hit][by_place]
            new = np.ones(len(i), bool)
            new[1:] = (np.diff(i) != 1) | (np.diff(q) != 0)
            start = np.flatnonzero(new)
            chain = np.diff(np.append(start, len(i)))
            long = chain >= 3 * q[start] - length + 1
            s = start[long]
            out.append(np.stack([i[s], chain[long], np.full(len(s), length), q[s]], axis=1))
        recurs = np.zeros(len(p), bool)
        recurs[1:] |= same
        recurs[:-1] |= same
        dense = np.concatenate([[0], np.cumsum(~same)])
        named = np.full(len(code), -1, np.int64)
        named[p[recurs]] = dense[recurs]
        left = np.sort(p[recurs])
        left = left[left + 2 * length <= end[left]]
        left = left[named[left + length] >= 0]
        at, name = left, named[left] * np.int64(len(code)) + named[left + length]
        length *= 2
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def word_runs(code: np.ndarray, first: np.ndarray, least: int = 4, shortest: int = 6) -> np.ndarray:
    """(document, start in it, length, period) of every run, by document, start
    and period. ``least`` periods, 4 or more, and ``shortest`` words."""
    if least < 4:
        raise ValueError("a chain is only sure to be whole in runs of four periods or more")
    found = _proposals(code, first)
    if not len(found):
        return np.zeros((0, 4), np.int64)
    q = found[:, 3]
    doc = np.searchsorted(first, found[:, 0], side="right") - 1
    lo, hi = found[:, 0], found[:, 0] + found[:, 1] + found[:, 2] - 1  # words equal to those q on: lo to hi - 1
    low, high = first[doc], first[doc + 1]
    for bound, move in ((low, -1), (high, 1)):  # extension; a whole chain needs no step
        live = np.arange(len(q))
        while live.size:
            j = (lo if move < 0 else hi)[live] + (move if move < 0 else 0)
            inside = (j >= bound[live]) if move < 0 else (j + q[live] < bound[live])
            live, j = live[inside], j[inside]
            equal = code[j] == code[j + q[live]]
            live = live[equal]
            if move < 0:
                lo[live] -= 1
            else:
                hi[live] += 1
    length = hi - lo + q
    keep = length >= np.maximum(shortest, least * q)
    runs = np.unique(np.stack([doc, lo - low, q, length], axis=1)[keep], axis=0)
    return runs[:, [0, 1, 3, 2]]


def _slice_runs(texts: list[list[bytes]], least: int, shortest: int) -> list[np.ndarray]:
    """Per document: its (start, length, period) rows."""
    number: dict[bytes, int] = {}
    seen = number.setdefault
    first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    code = np.fromiter((seen(w, len(number)) for words in texts for w in words), np.int64, int(first[-1]))
    runs = word_runs(code, first, least, shortest)
    border = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    return [runs[a:b, 1:] for a, b in zip(border[:-1].tolist(), border[1:].tolist())]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


def find_runs(docs: DataFrame, *, least: int = 4, shortest: int = 6, id_col: str = "doc_id", text_col: str = "text",
              collapsed: bool = True, change: Callable[[list[bytes], bytes], list[bytes]] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period, in
    order) and, if asked for, the text ``collapsed``: the words that no run holds
    after its first period, joined by one space.

    Words lie between spaces and the control characters 9 to 13. ``change``
    rewrites a row's words, given the id as text, before they are searched."""
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN))]
    out = T.StructType(fields + [T.StructField("collapsed", T.StringType())] * collapsed)
    kind = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def work():
        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index(text_col)))
            ids = b.column(b.schema.get_field_index(id_col)).to_pylist() if change else None
            count, found, texts = [], [], []
            for lo, hi in slices_by_bytes(offsets, _SLICE):
                words = [raw[x:y].tobytes().split() for x, y in zip(offsets[lo:hi].tolist(), offsets[lo + 1:hi + 1].tolist())]
                if change:
                    words = [change(w, b"" if i is None else str(i).encode()) for w, i in zip(words, ids[lo:hi])]
                runs = _slice_runs(words, least, shortest)
                count += [len(w) for w in words]
                found += runs
                if collapsed:
                    texts += [b" ".join(collapse(w, r)) for w, r in zip(words, runs)]
            rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
            border = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=[f.name for f in RUN.fields])
            cols = [pa.array(count, pa.int64()), pa.ListArray.from_arrays(pa.array(border), parts).cast(kind)]
            return cols + [pa.array(texts, pa.binary()).cast(pa.string())] * collapsed

        return each

    return append_columns(docs, out, work)
