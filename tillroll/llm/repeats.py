"""Removal of repeated byte strings, found in column-wise built suffix orders.

A byte goes if a string of ``span`` bytes that covers it also starts in a document
with a smaller id. Such strings are the suffixes whose common prefix with a neighbour in
suffix order is ``span`` or more. That order is built for many short documents at once,
column by column: in every round each document gets one more symbol to the left, the new
suffixes are merged into the Burrows-Wheeler transform of the whole collection by
rank, and the common prefixes are carried along (one more than the least
one between two equal symbols). Transform and prefixes are read and written once per
round, in order; they are arrays here, as each collection is bounded. A symbol is five bytes
if they divide ``span``, else two if ``span`` is even, as fewer symbols are fewer rounds; each text is then
in the collection five times or twice, in every alignment. Wide symbols that come once in a
collection, in whatever alignment, are in no repeated string: they share one number that equals nothing.

Spark makes the bounded collections:

1. Every string of ``span`` bytes has an anchor, its ``gram`` bytes of least hash. Neighbouring
   strings with one anchor form a segment of at most ``2 * span - gram`` bytes. Equal strings
   have equal anchors, so they meet if segments are dealt by anchor.
2. The texts lie in a bucketed table, in chunks of a few MB, so that no later step
   shuffles them. Each chunk sends its anchors, each once with the number of its texts, to the
   anchors' buckets and learns which occur in several texts anywhere. Only those can matter.
3. The distinct segments of repeated anchors, with their smallest id, are dealt by
   anchor; those of an anchor repeated very often are cut into strings of
   ``span`` bytes first and dealt by their content, so that no collection
   grows with one anchor. Each collection is put in suffix order, and every
   string's smallest id goes back to the chunks.
4. Each chunk marks the covered bytes of its documents and drops them.

A frequent string costs one row per chunk, not one per document.

Defined results: matches never cross documents; null text is empty; a null id is larger
than all others, so such a row removes from no numbered one; rows of one id
do not remove from each other; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import complete_groups, slices_by_bytes, small_batches, stage, tidied, utf8
from tillroll.llm.textvec import mix, powers
from tillroll.session import shared_path

_SLICE = 1 << 19  # bytes hashed at once
_PLACE = np.uint64((1 << 22) - 1)
_CHUNK = 4 << 20  # text bytes of a chunk
_ANCHORS = 1 << 20  # anchors of a bucket
_COLLECTION = 10_000  # segments of a collection
_HOT = 4096  # an anchor repeated more often has its segments cut up
_PLACES = 1 << 16  # places of a chunk looked at together
_FEW = 4096  # symbols that Arrow sorts by counting
_NO_ID = (1 << 63) - 1


def _pieces(at: np.ndarray, span: int) -> Iterator[np.ndarray]:
    """Offsets of texts to be looked at together; a long text in pieces that share span - 1 bytes."""
    for lo, hi in slices_by_bytes(at, _SLICE):
        if hi == lo + 1 and at[hi] - at[lo] > _SLICE:
            for a in range(int(at[lo]), int(at[hi]) - span + 1, _SLICE):
                yield np.array([a, min(int(at[hi]), a + _SLICE + span - 1)])
        else:
            yield at[lo:hi + 1]


def segments(raw: np.ndarray, at: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last start of the strings of every segment, and its anchor's hash."""
    out = []
    for own in _pieces(at, span):
        base, n = int(own[0]), int(own[-1] - own[0])
        if n < span:
            continue
        fwd, inv = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((raw[base:base + n] + np.uint64(1)) * fwd[:n], out=total[1:])
        code = mix((total[gram:] - total[:-gram]) * inv[:n - gram + 1])
        least = (code & ~_PLACE) | np.arange(len(code), dtype=np.uint64)  # the first of equal ones
        width, wanted = 1, span - gram + 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[:width - wanted], least[wanted - width:])
        place = (least & _PLACE).astype(np.int64)
        inside = np.zeros(n + 2, np.int32)
        size = np.diff(own)
        some = size >= span
        np.add.at(inside, own[:-1][some] - base, 1)
        np.add.at(inside, own[1:][some] - base - span + 1, -1)
        start = np.flatnonzero(np.cumsum(inside[:len(place)]))
        if not start.size:
            continue
        anchor = place[start]
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(anchor) != 0) | (np.diff(start) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(start) - 1)
        # a text's end also ends a segment
        out.append((start[first] + base, start[last] + base, code[anchor[first]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _sorted(symbol: np.ndarray, few: bool = True) -> np.ndarray:
    """Places of symbols in (stable) order; Arrow counts numbers of a small range in one pass."""
    if not few:
        return np.argsort(symbol, kind="stable")  # by digits
    return pc.array_sort_indices(pa.array(symbol)).to_numpy().view(np.int64)


class Collection:
    """Suffix order of many short texts of symbols 1 and up: the transform (0 before a text's first
    symbol) and the prefix shared with the suffix before, up to ``most`` symbols. A symbol ``alone``
    is like no other, not even its own kind."""

    def __init__(self, symbol: np.ndarray, at: np.ndarray, most: int, alone: int | None = None) -> None:
        self.n = n = len(at) - 1
        # round 0: the empty suffixes, in the order of the texts
        padded = np.append(symbol.astype(np.uint16), np.uint16(0))
        left = at[1:] - 1  # place of each text's next symbol
        text, place = np.arange(n), np.arange(n)
        bwt = np.where(left >= at[:-1], padded[left], np.uint16(0))
        shared = np.zeros(n, np.uint8)
        few = symbol.max(initial=0) < _FEW
        while True:
            order = _sorted(bwt, few)  # equal symbols in suffix order
            order = order[len(bwt) - np.count_nonzero(bwt):]
            latest = np.zeros(len(bwt), bool)
            latest[place] = True
            grown = np.flatnonzero(latest.take(order))
            if not grown.size:
                break
            # the texts in the order of their new suffixes
            by = _sorted(bwt[place], few)
            text = text[by[len(by) - len(grown):]]
            left[text] -= 1
            new = n + grown
            size = len(bwt) + len(grown)
            stays = np.ones(size, bool)
            stays[new] = False
            now, with_before = np.empty(size, np.uint16), np.empty(size, np.uint8)
            now[stays], with_before[stays] = bwt, shared
            now[new] = np.where(left[text] >= at[text], padded[left[text]], np.uint16(0))
            changed = np.repeat(grown, 2)  # the new suffixes and those behind them
            changed[1::2] += 1
            changed = changed[np.append(True, changed[1:] != changed[:-1]) & (changed < len(order))]
            with_before[n + changed] = self._prefixes(bwt, shared, order, changed, most, alone)
            bwt, shared, place = now, with_before, new
        self.bwt, self.shared, self.order = bwt, shared, order

    @staticmethod
    def _prefixes(bwt: np.ndarray, shared: np.ndarray, order: np.ndarray, at: np.ndarray, most: int,
                  alone: int | None) -> np.ndarray:
        """One more than the least prefix between the equal symbols at - 1 and
        at, or 0 where another symbol comes before."""
        lo, hi = order[np.maximum(at - 1, 0)], order[at]
        before, here = bwt[lo], bwt[hi]
        same = (at > 0) & (before == here)
        if alone is not None:
            same &= here != alone
        out = np.zeros(len(at), np.uint8)
        which = np.flatnonzero(same)
        a, b = lo[which] + 1, hi[which] + 1
        level = (np.frexp((b - a).astype(np.float64))[1] - 1).astype(np.uint8)
        by = _sorted(level)
        border = np.searchsorted(level[by], np.arange(int(level.max(initial=0)) + 2))
        least = shared
        for k in range(len(border) - 1):  # least of 2**k neighbours
            x = by[border[k]:border[k + 1]]
            out[which[x]] = np.minimum(least[a[x]], least[b[x] - (1 << k)])
            if k + 2 < len(border):
                least = np.minimum(least[:-(1 << k)], least[1 << k:])
        out[which] = np.minimum(out[which], most - 1) + 1
        return out

    def suffixes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, texts, places in suffix order) of all suffixes, by length."""
        step = np.full(len(self.bwt), -1, np.int64)
        step[self.order] = self.n + np.arange(len(self.order))
        text, place, length = np.arange(self.n), np.arange(self.n), 0
        while True:
            place = step[place]
            there = place >= 0
            text, place, length = text[there], place[there], length + 1
            if not text.size:
                return
            yield length, text, place


def _texts_of_symbols(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """The texts as texts of symbols of ``width`` bytes, numbered from 1, those that come once all with
    the last number (third value); None if there are too many for two bytes. Every text comes
    ``width`` times, each time (behind all others) without one more of its last bytes, so that each start is in one of them."""
    length, n = np.diff(at), max(0, len(raw) - width + 1)
    key = np.zeros(n, np.int64)
    for k in range(width):
        key <<= 8
        key |= raw[k:k + n]
    left = (np.repeat(at[1:], length) - np.arange(len(raw)))[:n]  # bytes to the text's end
    turn = (left % width).astype(np.uint8)
    turn[left < width] = width
    by = _sorted(turn)[:n - np.count_nonzero(turn == width)]
    coded = pa.array(key.take(by)).dictionary_encode()
    code = coded.indices.to_numpy()
    often = np.bincount(code, minlength=1) > 1
    alone = int(np.count_nonzero(often)) + 1
    if alone >= 1 << 16:
        return None
    number = np.where(often, np.cumsum(often), alone).astype(np.uint16)
    each = np.concatenate([np.maximum(length - skip, 0) // width for skip in range(width)])
    return number.take(code), np.append(0, np.cumsum(each)), alone


def smallest_ids(raw: np.ndarray, at: np.ndarray, ids: np.ndarray, span: int) -> np.ndarray:
    """For each text (row) and start (column) the smallest id of all texts that hold
    the ``span`` bytes there; ``_NO_ID`` behind the last start."""
    for width in (5, 2, 1):  # the fewer symbols the fewer rounds
        texts = None if span % width else _texts_of_symbols(raw, at, width)
        if texts:
            break
    own = Collection(texts[0], texts[1], span // width, texts[2])
    group = np.cumsum(own.shared < span // width)
    least = np.full(int(group[-1]) + 1 if len(group) else 1, _NO_ID)
    size, found = np.diff(at), []
    text_of = np.tile(np.arange(len(size)), width)
    ends = np.concatenate([size - skip for skip in range(width)])
    for length, text, place in own.suffixes():
        if width * length >= span:
            start, text, of = ends[text] - width * length, text_of[text], group[place]
            found.append((text, start, of))
            np.minimum.at(least, of, ids[text])
    out = np.full((len(size), max(1, int(size.max(initial=span)) - span + 1)), _NO_ID)
    for text, start, g in found:
        out[text, start] = least[g]
    return out


def _runs(least: np.ndarray, size: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, id) of neighbouring starts with one id."""
    text, start = np.nonzero(np.arange(least.shape[1]) < (size - span + 1)[:, None])
    value = least[text, start]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], start[last], value[first]


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of packed numbers, and how many each row has."""
    parts = column.to_pylist()
    width = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), np.array([len(x) // width for x in parts], np.int64)


def _cut(border: np.ndarray, *values: np.ndarray) -> list[list[bytes]]:
    return [[v[a:b].tobytes() for a, b in zip(border[:-1].tolist(), border[1:].tolist())] for v in values]


def _chunked(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """(chunk, row, id, text) as a table bucketed by chunk, and its text bytes."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    chunk_bytes = max(chunk_bytes, min(64 << 20, total // 100_000))
    chunks = total // chunk_bytes + 1
    buckets = int(min(max(spark.sparkContext.defaultParallelism, total // (16 << 20)), 20_000, max(chunks, 2)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks)))
    path = shared_path(spark, "llm", "repeats", unique=True)
    name = "repeats_" + path.rsplit("-", 1)[1]
    (rows.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk").sortBy("chunk")
     .option("path", path).option("compression", "zstd").saveAsTable(name))
    table = spark.table(name).select("chunk", "row", "id", "text")
    table.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return table, total


def _repeated_anchors(table: DataFrame, buckets: int, span: int, gram: int, most: int) -> DataFrame:
    """(chunk, bucket, codes, hot): the anchors of each chunk that are repeated
    anywhere, and which of them are very often."""
    @tidied
    def send(batches):
        for b in batches:
            chunk = b.column(0).to_numpy()
            border = np.concatenate([[0], np.flatnonzero(np.diff(chunk)) + 1, [len(chunk)]])
            for lo, hi in zip(border[:-1].tolist(), border[1:].tolist()):
                if lo == hi:
                    continue
                raw, at = utf8(b.column(1).slice(lo, hi - lo))
                first, _, code = segments(raw, at, span, gram)
                if not len(code):
                    continue
                bucket, low = (code >> np.uint64(32)) % np.uint64(buckets), code & np.uint64(0xFFFFFFFF)
                key, text = (bucket << np.uint64(32)) | low, np.searchsorted(at, first, side="right")
                order = np.argsort(key, kind="stable")  # texts stay in order
                key, text = key[order], text[order]
                once = np.ones(len(key), bool)  # in each text
                once[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
                key, n = np.unique(key[once], return_counts=True)
                of = (key >> np.uint64(32)).astype(np.int64)
                start = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1])
                codes, counts = _cut(np.append(start, len(key)), key.astype("<u4"), np.minimum(n, 255).astype(np.uint8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[start]), pa.array(np.full(len(start), chunk[lo])), pa.array(codes, pa.binary()),
                     pa.array(counts, pa.binary())], names=["bucket", "chunk", "codes", "counts"])

    @tidied
    def meet(batches):
        for t, border in complete_groups(batches, ["bucket"]):
            for lo, hi in zip(border[:-1].tolist(), border[1:].tolist()):
                part = t.slice(lo, hi - lo)
                code, n = _joined(part.column("codes"), "<u4")
                times = _joined(part.column("counts"), np.uint8)[0].astype(np.int64)
                order = np.argsort(code, kind="stable")
                code, times, chunk = code[order], times[order], np.repeat(part.column("chunk").to_numpy(), n)[order]
                start = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
                total = np.repeat(np.add.reduceat(times, start), np.diff(np.append(start, len(code))))
                keep = total > 1
                code, chunk, hot = code[keep], chunk[keep], (total[keep] > most).astype(np.uint8)
                order = np.argsort(chunk, kind="stable")
                code, chunk, hot = code[order], chunk[order], hot[order]
                if not len(code):
                    continue
                start = np.concatenate([[0], np.flatnonzero(np.diff(chunk)) + 1])
                codes, hots = _cut(np.append(start, len(code)), code, hot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[start]), pa.array(np.full(len(start), part.column("bucket")[0].as_py())),
                     pa.array(codes, pa.binary()), pa.array(hots, pa.binary())], names=["chunk", "bucket", "codes", "hot"])

    sent = table.select("chunk", "text").mapInArrow(send, "bucket long, chunk long, codes binary, counts binary")
    return (sent.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(meet, "chunk long, bucket long, codes binary, hot binary"))


_SEGMENTS = ("route long, chunk long, strings binary, sizes binary, least binary, most binary, "
             "of_row binary, of_start binary, of_string binary")


def _dealt_segments(table: DataFrame, repeated: DataFrame, buckets: int, routes: int, span: int, gram: int) -> DataFrame:
    """The distinct segments of repeated anchors in each chunk, by route, with the
    smallest id there, how much larger the largest is, and all places (row's number in the
    chunk, start, number of the segment)."""
    def deal(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in _SEGMENTS.split(", ")]
        kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 7
        empty = pa.table([pa.array([], k) for k in kinds], names=names)
        if not rows.num_rows or not anchors.num_rows:
            return empty
        known, n = _joined(anchors.column("codes"), "<u4")
        known = known.astype(np.uint64) | (np.repeat(anchors.column("bucket").to_numpy(), n).astype(np.uint64) << np.uint64(32))
        order = np.argsort(known)
        known, hot = known[order], _joined(anchors.column("hot"), np.uint8)[0][order]
        raw, at = utf8(rows.column("text"))
        first, last, code = segments(raw, at, span, gram)
        key = (((code >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (code & np.uint64(0xFFFFFFFF))
        where = np.minimum(np.searchsorted(known, key), len(known) - 1)
        found = known[where] == key
        first, last, key, hot = first[found], last[found], key[found], hot[where[found]] == 1
        route = (mix(key) % np.uint64(routes)).astype(np.int64)
        count = np.where(hot, last - first + 1, 1)  # a hot anchor's strings are dealt one by one
        lo = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        hi = np.where(np.repeat(hot, count), lo, np.repeat(last, count)) + span
        route, hot = np.repeat(route, count), np.repeat(hot, count)
        data, number = raw.tobytes(), {}
        seen = number.setdefault
        string = np.fromiter((seen(data[a:b], len(number)) for a, b in zip(lo.tolist(), hi.tolist())), np.int64, len(lo))
        if not len(string):
            return empty
        of = np.searchsorted(at, lo, side="right") - 1
        ids = rows.column("id").to_numpy()[of]
        n_strings = len(number)
        least, most = np.full(n_strings, _NO_ID), np.full(n_strings, -_NO_ID - 1)
        np.minimum.at(least, string, ids)
        np.maximum.at(most, string, ids)
        to = np.zeros(n_strings, np.int64)
        to[string] = route
        texts = list(number)
        for k in np.unique(string[hot]).tolist():
            to[k] = zlib.crc32(texts[k]) % routes
        order = np.argsort(to, kind="stable")
        rank = np.empty(n_strings, np.int64)
        rank[order] = np.arange(n_strings)
        to = to[order]
        start = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1])
        border = np.append(start, n_strings)
        size = np.array([len(texts[k]) for k in order.tolist()], np.uint16)
        pack = pa.Codec("zstd", compression_level=1).compress
        strings = [pack(b"".join(texts[k] for k in order[a:b].tolist()), asbytes=True)
                   for a, b in zip(border[:-1].tolist(), border[1:].tolist())]
        sizes, leasts, mosts = _cut(border, size, least[order], (most - least)[order])
        place = rank[string]
        by = np.argsort(place, kind="stable")
        place = place[by]
        group = np.searchsorted(start, place, side="right") - 1
        edge = np.searchsorted(group, np.arange(len(start) + 1))
        number_of = np.argsort(np.argsort(rows.column("row").to_numpy()))  # of each row among the chunk's
        of_row, of_start, of_string = _cut(edge, number_of[of][by].astype(np.uint32), (lo - at[of])[by].astype(np.uint32),
                                           (place - start[group]).astype(np.uint32))
        chunk = rows.column("chunk")[0].as_py()
        got = [to[start], np.full(len(start), chunk), strings, sizes, leasts, mosts, of_row, of_start, of_string]
        return pa.table([pa.array(x, k) for x, k in zip(got, kinds)], names=names)

    return table.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(deal, _SEGMENTS)


def _answers(dealt: DataFrame, span: int) -> DataFrame:
    """(chunk, route, string, first, last, least): for each segment of a chunk, the ranges of starts
    whose string has a smaller id somewhere than an id that the chunk has it with."""
    @tidied
    def run(batches):
        for t, border in complete_groups(batches, ["route"]):
            for lo, hi in zip(border[:-1].tolist(), border[1:].tolist()):
                part = t.slice(lo, hi - lo)
                size, n = _joined(part.column("sizes"), np.uint16)
                border_of = np.concatenate([[0], np.cumsum(n)])
                each = np.add.reduceat(size.astype(np.int64), border_of[:-1])  # a chunk's part is never empty
                unpack = pa.Codec("zstd").decompress
                data = b"".join(unpack(x, int(k), asbytes=True) for x, k in zip(part.column("strings").to_pylist(), each.tolist()))
                ends = np.cumsum(size, dtype=np.int64)
                number: dict[bytes, int] = {}
                seen = number.setdefault
                string = np.fromiter((seen(data[b - s:b], len(number)) for b, s in zip(ends.tolist(), size.tolist())),
                                     np.int64, len(size))
                own = np.zeros(len(number), np.int64)
                own[string] = size
                least = np.full(len(number), _NO_ID)
                mine = _joined(part.column("least"), np.int64)[0]
                most = mine + _joined(part.column("most"), np.int64)[0]
                np.minimum.at(least, string, mine)
                raw = np.frombuffer(b"".join(number), np.uint8)
                found = smallest_ids(raw, np.concatenate([[0], np.cumsum(own)]), least, span)
                text, first, last, value = _runs(found, own, span)
                edge = np.searchsorted(text, np.arange(len(number) + 1))
                times = (edge[string + 1] - edge[string])
                which = np.repeat(np.arange(len(string)), times)
                run_of = np.repeat(edge[string] - np.cumsum(times) + times, times) + np.arange(len(which))
                lower = value[run_of] < most[which]
                which, run_of = which[lower], run_of[lower]
                base = np.cumsum(n) - n
                row = np.searchsorted(base, which, side="right") - 1
                edge = np.searchsorted(row, np.arange(part.num_rows + 1))
                cols = _cut(edge, (which - base[row]).astype(np.uint32), first[run_of].astype(np.uint16),
                            last[run_of].astype(np.uint16), value[run_of])
                some = pa.array(np.flatnonzero(np.diff(edge)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("chunk").combine_chunks().take(some), part.column("route").combine_chunks().take(some),
                     *[pa.array(c, pa.binary()).take(some) for c in cols]],
                    names=["chunk", "route", "string", "first", "last", "least"])

    return (dealt.select("route", "chunk", "strings", "sizes", "least", "most").repartition("route")
            .sortWithinPartitions("route").mapInArrow(run, "chunk long, route long, string binary, first binary, last binary, least binary"))


def _marked(table: DataFrame, dealt: DataFrame, answers: DataFrame, span: int) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cover(rows: pa.Table, told: pa.Table) -> pa.Table:
        raw, at = utf8(rows.column("text"))
        change = np.zeros(len(raw) + 1, np.int64)
        if told.num_rows and rows.num_rows:
            order = np.argsort(rows.column("row").to_numpy())
            ids = rows.column("id").to_numpy()
            told = told.sort_by("route")
            a, p = told.filter(told.column("answer")), told.filter(pc.invert(told.column("answer")))
            p = p.filter(pc.is_in(p.column("route"), a.column("route")))
            (string, n), (first, _), (last, _), (least, _) = (_joined(a.column(c), k) for c, k in (
                ("string", "<u4"), ("first", np.uint16), ("last", np.uint16), ("least", np.int64)))
            (of_row, _), (of_start, _), (of_string, n_places) = (_joined(p.column(c), "<u4") for c in ("of_row", "of_start", "of_string"))
            # a string's number holds in its route; both sides have one row a route, in one order
            known = np.repeat(np.arange(a.num_rows) << 32, n) | string
            asked = np.repeat(np.arange(p.num_rows) << 32, n_places) | of_string
            for block in range(0, len(asked), _PLACES):
                own = slice(block, block + _PLACES)
                lo, hi = np.searchsorted(known, asked[own], "left"), np.searchsorted(known, asked[own], "right")
                n = hi - lo
                which = np.repeat(np.arange(len(n)), n)
                run = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(which))
                row = order[of_row[own][which]]
                lower = least[run] < ids[row]
                which, run, row = which[lower], run[lower], row[lower]
                start = at[row] + of_start[own][which]
                np.add.at(change, start + first[run], 1)
                np.add.at(change, start + last[run] + span, -1)
        gone = np.cumsum(change[:-1]) > 0
        # spans within documents
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        inner = at[1:-1]
        inner = inner[inner < len(raw)]
        edge[inner] |= gone[inner]
        stop = gone.copy()
        stop[:-1] &= ~gone[1:]
        before = inner[inner > 0] - 1
        stop[before] |= gone[before]
        start, end = np.flatnonzero(edge), np.flatnonzero(stop) + 1
        of = np.searchsorted(at, start, side="right") - 1
        border = np.searchsorted(of, np.arange(len(at)))
        spans = pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(start - at[of]), pa.array(end - at[of])], names=["start", "end"])).cast(kind)
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[at[1:]] - total[at[:-1]]
        left = raw[~gone]
        rest = at - total[at]
        kept = [left[a:b].tobytes() for a, b in zip(rest[:-1].tolist(), rest[1:].tolist())]
        return pa.table([rows.column("id").combine_chunks() if rows.num_rows else pa.array([], pa.int64()),
                         pa.array(np.diff(at)), pa.array(removed.astype(np.int64)), spans, pa.array(kept, pa.binary())],
                        names=["id", "n_bytes", "n_removed", "spans", "kept"])

    none = [F.lit(None).cast("binary").alias(c) for c in ("string", "first", "last", "least")]
    places = dealt.select("chunk", "route", F.lit(False).alias("answer"), "of_row", "of_start", "of_string", *none)
    told = places.unionByName(answers.withColumn("answer", F.lit(True)), allowMissingColumns=True)
    return table.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        cover, "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")


def remove_repeats(docs: DataFrame, *, span: int = 50, gram: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = _CHUNK, hot: int = _HOT) -> DataFrame:
    """One row per row of ``docs``: the id (long), ``n_bytes``, ``n_removed``, ``spans``
    (start, end) of the maximal removed runs, in bytes, and the bytes ``kept``. The segments
    of an anchor in more than ``hot`` texts are dealt string by string."""
    if not 0 < gram <= span <= 1 << 14:
        raise ValueError("gram must be in 1..span, and span at most 16384")
    small_batches(docs)
    docs = docs.select(id_col, text_col)
    table, total = _chunked(docs, id_col, text_col, chunk_bytes)
    table = table.withColumn("id", F.coalesce("id", F.lit(_NO_ID)))
    buckets = 1 + 2 * total // ((span - gram + 2) * _ANCHORS)
    repeated = stage(_repeated_anchors(table, buckets, span, gram, hot), "anchors")
    some = repeated.agg(F.sum(F.octet_length("codes").cast("long"))).first()[0] or 0
    routes = 1 + some // 4 // _COLLECTION
    dealt = stage(_dealt_segments(table, repeated, buckets, routes, span, gram), "segments")
    answers = stage(_answers(dealt, span), "answers")
    return _marked(table, dealt, answers, span).select(
        F.when(F.col("id") != F.lit(_NO_ID), F.col("id")).alias(id_col), "n_bytes", "n_removed", "spans", "kept")
