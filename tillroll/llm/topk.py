"""Exact top-k search on a bit-sliced index.

A block of vectors is stored as bitmaps: for each component, one bitmap per bit
of its quantised value (the value above the block's minimum, without its lowest
bits). For a query, the product of a component with an integer weight is a sum
of shifted slices, one per signed digit of the weight. All those slices are
added with bitmap carry-save adders (xor / and / or over 64 rows a word), which
leaves the sums themselves as bit slices. The best rows are then selected from
the most significant slice downward. As the dropped low bits bound the error,
every row that could still belong to the top k is kept, and those boundary rows
are resolved by exact integer inner products.

Rows are dealt into blocks of bounded size. Each block is indexed once, and the
queries, a stated part of the table, pass by it in batches; at most k rows per query
leave a block. The index holds the rows whose components stay below 2**24 after
scaling. Others, and queries with larger components, take the plain exact product, in
64-bit integers where it is sure to fit and in Python's where not; a
score that does not fit a long is an error.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id; vectors are compared with those of equal length only; rows that share
an id are rows of their own, a query row is never its own candidate; ties go to
the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import arrow_schema, small_batches, stage, tidied

SCALE = 256
_NARROW = float(1 << 24)
_SLICES = 6  # bits kept of a component
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def signed_digits(weights: np.ndarray) -> np.ndarray:
    """Non-adjacent form: weights as sums of digit * 2**column, digits -1, 0, 1."""
    rest, out = weights.astype(np.int64).copy(), []
    while rest.any():
        odd = (rest & 1) != 0
        digit = np.where(odd, 2 - (rest & 3), 0)
        out.append(digit)
        rest = (rest - digit) >> 1
    return np.stack(out, axis=1) if out else np.zeros((len(rest), 0), np.int64)


class BitSlicedIndex:
    """Bitmaps of the quantised components of one block of integer vectors."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows.astype(np.int64)
        self.n, self.dims = rows.shape
        self.low = self.rows.min(axis=0)
        above = self.rows - self.low
        self.bits = min(_SLICES, max(1, int(above.max()).bit_length()))
        self.drop = max(0, int(above.max()).bit_length() - self.bits)
        kept = above >> self.drop
        self.words = -(-self.n // 64)
        slices = np.empty((self.dims * self.bits, self.words), np.uint64)
        for b in range(self.bits):
            on = np.zeros((self.dims, self.words * 64), np.uint8)
            on[:, :self.n] = ((kept >> b) & 1).T
            slices[b::self.bits] = np.packbits(on, axis=1, bitorder="little").view(np.uint64)
        self.slices = np.concatenate([slices, ~slices])  # the second half subtracts
        self.valid = np.zeros(self.words * 64, np.uint8)
        self.valid[:self.n] = 1
        self.valid = np.packbits(self.valid, bitorder="little").view(np.uint64)

    def weighted_sum(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bit slices (lowest first) of sum(weight * kept component), plus the
        constant that makes it non-negative."""
        digits, half = signed_digits(weights), self.dims * self.bits
        at: dict[int, list] = {}
        constant = 0
        for c in range(digits.shape[1]):
            some = np.flatnonzero(digits[:, c])
            if not some.size:
                continue
            negative = digits[some, c] < 0
            first = some * self.bits + np.where(negative, half, 0)
            # -x = ~x + 1 - 2**bits, digit by digit
            constant += int(negative.sum()) * (((1 << self.bits) - 1) << c)
            for b in range(self.bits):
                at.setdefault(c + b, []).append(first + b)
        total, carried, w = [], [], 0
        top = max(at, default=-1)
        while w <= top or carried:
            stack = [self.slices[np.concatenate(at[w])]] if w in at else []
            stack += carried
            maps, carried = (np.concatenate(stack) if stack else np.zeros((1, self.words), np.uint64)), []
            while len(maps) > 1:
                if len(maps) == 2:
                    carried.append((maps[0] & maps[1])[None])
                    maps = (maps[0] ^ maps[1])[None]
                    break
                m = len(maps) // 3
                a, b, c = maps[:m], maps[m:2 * m], maps[2 * m:3 * m]
                ab = a ^ b
                carried.append((a & b) | (c & ab))
                maps = np.concatenate([ab ^ c, maps[3 * m:]])
            total.append(maps[0])
            w += 1
        return total, constant

    def _kth(self, total: list[np.ndarray], k: int) -> int:
        """The k-th largest sum, bit by bit from the most significant slice."""
        sure, maybe, value = np.zeros(self.words, np.uint64), self.valid, 0
        for i in range(len(total) - 1, -1, -1):
            on = maybe & total[i]
            if int(np.bitwise_count(sure | on).sum()) >= k:
                maybe, value = on, value | (1 << i)
            else:
                sure, maybe = sure | on, maybe & ~total[i]
        return value

    def _at_least(self, total: list[np.ndarray], bound: int) -> np.ndarray:
        """Bitmap of the rows whose sum is ``bound`` or more."""
        if bound <= 0:
            return self.valid
        if bound.bit_length() > len(total):
            return np.zeros(self.words, np.uint64)
        more, same = np.zeros(self.words, np.uint64), self.valid
        for i in range(len(total) - 1, -1, -1):
            if bound >> i & 1:
                same = same & total[i]
            else:
                more, same = more | (same & total[i]), same & ~total[i]
        return more | same

    def candidates(self, weights: np.ndarray, k: int) -> np.ndarray:
        """Rows that may be among the k best inner products."""
        if self.n <= k:
            return np.arange(self.n)
        total, _ = self.weighted_sum(weights)
        # the dropped bits of a component are worth 0 .. 2**drop - 1
        spread = int(np.abs(weights.astype(np.int64)).sum()) * ((1 << self.drop) - 1)
        slack = -(-spread // (1 << self.drop))
        rows = self._at_least(total, self._kth(total, k) - slack)
        bits = np.unpackbits(rows.view(np.uint8), bitorder="little")[:self.n]
        return np.flatnonzero(bits)


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """Valid rows as (id, dims, whole, _task, _place): floor(scale * x) as
    little-endian doubles, and the row's number (stage the result before use)."""
    small_batches(vectors)
    fields = T.StructType([T.StructField(id_col, vectors.schema[id_col].dataType),
                           T.StructField("dims", T.IntegerType()), T.StructField("whole", T.BinaryType()),
                           T.StructField("_task", T.IntegerType()), T.StructField("_place", T.LongType())])
    kind = arrow_schema(fields)

    @tidied
    def run(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            ids, lists = b.column(0), b.column(1).cast(pa.list_(pa.float64()))
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False) if len(lists.values) else np.zeros(0)
            fine = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])  # nan and null fail
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(flat * scale)
            size = np.diff(offsets)
            keep = np.flatnonzero((fine[offsets[1:]] == fine[offsets[:-1]]) & (size > 0)
                                  & lists.is_valid().to_numpy(zero_copy_only=False)
                                  & ids.is_valid().to_numpy(zero_copy_only=False))
            rows = [whole[offsets[i]:offsets[i + 1]].astype("<f8").tobytes() for i in keep.tolist()]
            n, seen = len(keep), seen + len(keep)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep)), pa.array(size[keep], pa.int32()),
                                              pa.array(rows, pa.binary()), pa.array(np.full(n, task, np.int32)),
                                              pa.array(np.arange(seen - n, seen))], schema=kind)

    return vectors.select(id_col, vector_col).mapInArrow(run, fields)


def _exact(rows: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly."""
    if len(rows) and len(vec) * float(np.abs(rows).max()) * float(np.abs(vec).max()) < 2.0 ** 62:
        return rows.astype(np.int64) @ vec.astype(np.int64)
    if not (np.isfinite(rows).all() and np.isfinite(vec).all()):
        raise OverflowError("a component is too large to be scaled")
    whole = [int(x) for x in vec.tolist()]
    found = [sum(int(x) * y for x, y in zip(row, whole)) for row in rows.tolist()]
    if any(abs(x) >= 1 << 63 for x in found):
        raise OverflowError("a score does not fit 64 bits")
    return np.array(found, np.int64)


class _Block:
    """The rows of a block with one number of dimensions, indexed once."""

    def __init__(self, rows: pa.Table, dims: int) -> None:
        self.rows = np.frombuffer(b"".join(rows.column("whole").to_pylist()), "<f8").reshape(-1, dims)
        self.uids, self.ids = rows.column("uid").to_numpy(), rows.column("id").to_pylist()
        self.by_id = np.empty(len(self.ids), np.int64)
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i], self.uids[i]))
        self.by_id[np.array(order, np.int64)] = np.arange(len(self.ids))
        narrow = (np.abs(self.rows) <= _NARROW).all(axis=1)
        self.narrow, self.wide = np.flatnonzero(narrow), np.flatnonzero(~narrow)
        self.index = BitSlicedIndex(self.rows[self.narrow]) if self.narrow.size else None

    def best(self, vec: np.ndarray, uid: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows, but the query's own, and their scores."""
        if self.index is None or np.abs(vec).max() > _NARROW:
            maybe = np.arange(len(self.ids))
        else:  # one more, as the query's own row may be there
            maybe = np.concatenate([self.narrow[self.index.candidates(vec.astype(np.int64), k + 1)], self.wide])
        maybe = maybe[self.uids[maybe] != uid]
        score = _exact(self.rows[maybe], vec)
        best = np.lexsort((self.by_id[maybe], -score))[:k]
        return maybe[best], score[best]


def top_k(vectors: DataFrame, is_query, k: int = 5, *, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = SCALE, block_rows: int = 8192) -> DataFrame:
    """The ``k`` best rows of every query row (``is_query``: a condition on the
    id): ``query_id``, ``rank``, ``vec_id``, ``score``."""
    table = stage(quantise(vectors, id_col, vector_col, scale), "topk")
    blocks = max(1, -(-table.count() // block_rows))
    uid = (F.col("_task").cast("long") * F.lit(1 << 40) + F.col("_place")).alias("uid")
    # dealt by place, so repeated ids and vectors spread too
    rows = table.select(F.pmod(F.xxhash64("_task", "_place"), F.lit(blocks)).alias("block"), F.lit(False).alias("asks"),
                        F.col(id_col).alias("id"), "dims", "whole", uid)
    queries = table.filter(is_query).select(F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
                                            F.lit(True).alias("asks"), F.col(id_col).alias("id"), "dims", "whole", uid)
    id_type = vectors.schema[id_col].dataType
    fields = T.StructType([T.StructField("query_uid", T.LongType()), T.StructField("query_id", id_type),
                           T.StructField("vec_id", id_type), T.StructField("uid", T.LongType()),
                           T.StructField("score", T.LongType())])
    kind = arrow_schema(fields)

    @tidied
    def search(batches):
        block, held, made = None, [], {}
        for b in batches:
            number, asks = b.column("block").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
            new = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if number[lo] != block:
                    block, held, made = number[lo], [], {}
                if not asks[lo]:  # the rows of a block come before its queries
                    held.append(part)
                    continue
                out: list[list] = [[] for _ in fields]
                for q, dims, whole, qid in zip(*(part.column(c).to_pylist() for c in ("uid", "dims", "whole", "id"))):
                    if dims not in made:
                        rows = pa.Table.from_batches(held, part.schema)
                        rows = rows.filter(pc.equal(rows.column("dims"), dims))
                        made[dims] = _Block(rows, dims) if rows.num_rows else None
                    own = made[dims]
                    if own is None:
                        continue
                    found, score = own.best(np.frombuffer(whole, "<f8"), q, k)
                    for i, s in zip(found.tolist(), score.tolist()):
                        for c, x in zip(out, (q, qid, own.ids[i], int(own.uids[i]), s)):
                            c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, kind)], schema=kind)

    found = (rows.unionByName(queries).repartition("block").sortWithinPartitions("block", "asks")
             .mapInArrow(search, fields))
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("uid"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
