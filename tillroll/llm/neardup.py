"""Near-duplicate detection: SuperMinHash, banding, verification, union-find.

1. A text's set is its distinct ``k``-word shingles. Texts with equal sets
   form a class; everything after works on classes, so exact copies cost one
   row each.
2. SuperMinHash: every shingle draws a random permutation of the signature's
   places, step by step, and step j offers the value j + fraction; a place keeps
   its least offer. Values of one shingle are spread over all places (correlated
   ranks), which lowers the variance, and a text stops as soon as no later step
   can lower any place.
3. Banding: 32 bands of 4 places. A pair at similarity 0.8 shares no band with
   probability (1 - 0.8**4)**32 < 5e-8. There is no cap on bucket sizes.
4. Round one: within each bucket (in blocks of bounded size) the signatures
   give a heaviest spanning forest, and its edges are verified on the full
   shingle sets. Union-find groups the classes.
5. Round two, for the links that the forest missed: in each bucket that still
   holds several groups, all pairs across groups whose signatures are not
   clearly below the threshold (6 standard deviations) are tested on full sets
   too, each in the first band it shares. They are tested where the bucket's
   rows meet and never listed; pairs within a group need no test. Larger buckets
   are dealt into block pairs, the rows outside the bucket's largest group
   against all.

Verification compares full sets, recomputed from the whole texts. Components
are contracted on the executors; nothing grows with the corpus on the driver.

Defined results: null and wordless texts have an empty set and stand alone;
fewer than ``k`` words count as one shingle; repeated rows and ids share a
class; null ids are ignored when the smallest id is chosen; extra columns are
left out of the search and kept by ``deduplicate``, which keeps one row of each
group, also where several classes hold its smallest id or all its ids are null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, complete_groups, gathered, slices_by_bytes, small_batches, tidied, utf8
from tillroll.llm.common import stage as write_table
from tillroll.llm.components import components, spanning_forest
from tillroll.llm.textvec import SPACED, mix, scan_words, shingles


def stage(df: DataFrame, name: str) -> DataFrame:
    """A staged table of something that comes out of a shuffle."""
    return write_table(gathered(df), name)


PLACES, BANDS = 128, 32
_ROWS = PLACES // BANDS
_FRACTION = 25  # bits of a value's fraction; the rest is its rank
_SLICE = 2 << 20
_ELEMENTS = 1 << 17
_HELD = 32 << 20  # bytes of shingle sets held while a block is verified
BLOCK = 512  # classes of one bucket compared at once
_STEP = np.uint64(0x9E3779B97F4A7C15)


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (uint16, ``PLACES`` each) of sets of 64-bit hashes."""
    best = np.full((len(sets), PLACES), 0xFFFFFFFF, np.uint32)
    lo = 0
    while lo < len(sets):
        hi, held = lo, 0
        while hi < len(sets) and (hi == lo or held + len(sets[hi]) <= _ELEMENTS):
            held += len(sets[hi])
            hi += 1
        if hi == lo + 1 and held > _ELEMENTS:  # offers are minimised, so a large set may go in parts
            for at in range(0, held, _ELEMENTS):
                part = superminhash_block([sets[lo][at:at + _ELEMENTS]])
                best[lo] = np.minimum(best[lo], part[0])
        else:
            best[lo:hi] = superminhash_block(sets[lo:hi])
        lo = hi
    return (mix(best.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def superminhash_block(sets: list[np.ndarray]) -> np.ndarray:
    n = len(sets)
    best = np.full(n * PLACES, 0xFFFFFFFF, np.uint32)
    element = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    order = np.tile(np.arange(PLACES, dtype=np.uint8), (len(element), 1))
    for j in range(PLACES):
        if j:  # a text is done when its highest value is below rank j
            open_ = best.reshape(n, PLACES).max(axis=1) >= np.uint32(j << _FRACTION)
            keep = open_[owner]
            if not keep.any():
                break
            if not keep.all():
                element, owner, order = element[keep], owner[keep], order[keep]
        draw = mix(element + np.uint64((j + 1) * int(_STEP) % (1 << 64)))
        fraction = (draw & np.uint64((1 << _FRACTION) - 1)).astype(np.uint32)
        pick = j + (((draw >> np.uint64(32)) * np.uint64(PLACES - j)) >> np.uint64(32)).astype(np.int64)
        row = np.arange(len(element))
        place = order[row, pick]
        order[row, pick] = order[:, j]
        np.minimum.at(best, owner * PLACES + place, np.uint32(j << _FRACTION) + fraction)
    return best.reshape(n, PLACES)


def _set_key(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def sketch(docs: DataFrame, text_col: str, k: int, signature: bool = True, **how) -> DataFrame:
    """Append ``n_shingles``, ``set_key`` (null for an empty set) and, if asked
    for, the ``signature``."""
    out = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("set_key", T.BinaryType())]
                       + [T.StructField("signature", T.BinaryType())] * signature)

    def work():
        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index(text_col)))
            cols: list[list] = [[], [], []]
            for lo, hi in slices_by_bytes(offsets, _SLICE):
                part = offsets[lo:hi + 1]
                sets = shingles(scan_words(raw[part[0]:part[-1]], part - part[0], SPACED), k)
                cols[0] += [len(s) for s in sets]
                cols[1] += [_set_key(s) for s in sets]
                if signature:
                    full = superminhash(sets)
                    cols[2] += [x.tobytes() if len(s) else None for x, s in zip(full, sets)]
            return cols[:2 + signature]

        return each

    return append_columns(docs, out, work, **how)


def _codes(bands: np.ndarray) -> np.ndarray:
    """Bucket of every band: its places and its number, hashed."""
    return mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP)


def _buckets(classes: DataFrame) -> DataFrame:
    """(code, c): one row per class and band."""
    kind = pa.schema([("code", pa.int64()), ("c", pa.int64())])

    @tidied
    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(n, BANDS)
            code = _codes(sig)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.ravel().view(np.int64)),
                 pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], schema=kind)

    return classes.select("c", "signature").mapInArrow(run, "code long, c long")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal places of every signature of ``a`` with every one of ``b``."""
    out = np.empty((len(a), len(b)), np.int32)
    step = max(1, (1 << 22) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i:i + step] = (a[i:i + step, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int32)
    return out


def _least_alike(threshold: float) -> int:
    """Equal places that a pair at the threshold reaches but for 6 sigma."""
    return int(PLACES * threshold - 6 * np.sqrt(PLACES * threshold * (1 - threshold)))


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint16).reshape(-1, PLACES)


def _pair_batch(pairs: list[np.ndarray]) -> pa.RecordBatch:
    ab = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    ab = np.unique(np.sort(ab, axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])


def _forest_pairs(members: DataFrame, least: int) -> DataFrame:
    """Round one: forest edges of each block of each bucket."""
    @tidied
    def run(batches):
        for t, border in complete_groups(batches, ["code", "block"]):
            c, sig = t.column("c").to_numpy(), _signatures(t)
            size, pairs = np.diff(border), []
            two = border[:-1][size == 2]
            if two.size:  # most buckets, all at once
                near = (sig[two] == sig[two + 1]).sum(axis=1) >= least
                pairs.append(np.stack([c[two[near]], c[two[near] + 1]], axis=1))
            for at, n in zip(border[:-1][size > 2].tolist(), size[size > 2].tolist()):
                own = slice(at, at + n)
                edges = spanning_forest(_alike(sig[own], sig[own]), least)
                if edges:
                    pairs.append(c[own][np.array(edges)])
            yield _pair_batch(pairs)

    dealt = members.select("code", "block", "c", "signature").repartition("code", "block")
    return dealt.sortWithinPartitions("code", "block").mapInArrow(run, "a long, b long").distinct()


def _cross(t: pa.Table, at: int, end: int, sig: np.ndarray, g: np.ndarray, least: int):
    """Candidate pairs of one block pair as (rows marked first, rows marked
    second, matrix): of different groups, near by signature, and in the first
    band that the two share, so that a pair is looked at once in all."""
    first, second = (t.column(n).slice(at, end - at).to_numpy(zero_copy_only=False) for n in ("first", "second"))
    x, y = at + np.flatnonzero(first), at + np.flatnonzero(second)
    if not x.size or not y.size:
        return x, y, np.zeros((x.size, y.size), bool)
    near = (_alike(sig[x], sig[y]) >= least) & (g[x][:, None] != g[y][None, :])
    bands = sig.view(np.uint64)
    codes = _codes(bands[x[:1]])[0].view(np.int64)
    band = int(np.flatnonzero(codes == t.column("code")[at].as_py())[0])
    p, q = np.nonzero(near)
    if band and p.size:
        near[p, q] = ~(bands[x[p], :band] == bands[y[q], :band]).any(axis=1)
    return x, y, near


def _cross_members(members: DataFrame, least: int) -> DataFrame:
    """Round two, first pass: of (code, i, j, c, g, signature, first, second),
    the rows that are in a candidate pair. Pairs are not listed."""
    @tidied
    def run(batches):
        for t, border in complete_groups(batches, ["code", "i", "j"]):
            g, sig, keep = t.column("g").to_numpy(), _signatures(t), np.zeros(t.num_rows, bool)
            for at, end in zip(border[:-1].tolist(), border[1:].tolist()):
                x, y, near = _cross(t, at, end, sig, g, least)
                keep[x] |= near.any(axis=1)
                keep[y] |= near.any(axis=0)
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    dealt = members.repartition("code", "i", "j").sortWithinPartitions("code", "i", "j")
    return dealt.mapInArrow(run, members.schema)


def _cross_links(members: DataFrame, texts: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """Round two, second pass: links of each block pair, verified on full sets.
    A pair that links found before it already join is not tested."""
    @tidied
    def run(batches):
        for t, border in complete_groups(batches, ["code", "i", "j"]):
            c, g, sig = t.column("c").to_numpy(), t.column("g").to_numpy(), _signatures(t)
            links = []
            for at, end in zip(border[:-1].tolist(), border[1:].tolist()):
                x, y, near = _cross(t, at, end, sig, g, least)
                if not near.any():
                    continue
                tree = {int(v): int(v) for v in np.unique(g[at:end])}

                def find(v):
                    while tree[v] != v:
                        v = tree[v] = tree[tree[v]]
                    return v

                sets = _SetsOf(t.column("text"), k)
                for p, q in zip(*(v.tolist() for v in np.nonzero(near))):
                    u, v = find(int(g[x[p]])), find(int(g[y[q]]))
                    if u != v and _is_link(sets[x[p]], sets[y[q]], percent):
                        tree[max(u, v)] = min(u, v)
                        links.append((int(c[x[p]]), int(c[y[q]])))
            yield _pair_batch([np.array(links, np.int64)] if links else [])

    rows = members.join(texts, "c").select("code", "i", "j", "c", "g", "signature", "first", "second", "text")
    return rows.repartition("code", "i", "j").sortWithinPartitions("code", "i", "j").mapInArrow(run, "a long, b long")


class _SetsOf:
    """Shingle sets of the texts of a column, made when asked for; the last ones,
    of some bytes, are kept."""

    def __init__(self, column: pa.ChunkedArray, k: int) -> None:
        self.column, self.k, self.kept, self.held = column, k, {}, 0

    def __getitem__(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        raw, offsets = utf8(self.column.slice(i, 1))
        found = shingles(scan_words(raw, offsets, SPACED), self.k)[0]
        self.kept[i] = found
        self.held += found.nbytes
        while self.held > _HELD and len(self.kept) > 1:
            self.held -= self.kept.pop(next(iter(self.kept))).nbytes
        return found


def _is_link(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are at least ``percent`` % alike."""
    small, large = (s, t) if len(s) <= len(t) else (t, s)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(s) + len(t) - shared)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are at least ``percent`` % alike."""
    left = texts.select(F.col("c").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("c").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    @tidied
    def run(batches):
        for batch in batches:
            keep = []
            (raw_a, at_a), (raw_b, at_b) = utf8(batch.column(2)), utf8(batch.column(3))
            for lo, hi in slices_by_bytes(at_a + at_b, _SLICE):
                x, y = (shingles(scan_words(raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], SPACED), k)
                        for raw, at in ((raw_a, at_a), (raw_b, at_b)))
                keep += [lo + i for i, (s, t) in enumerate(zip(x, y)) if _is_link(s, t, percent)]
            got = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(got), batch.column(1).take(got)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The sketched rows of ``docs``, and one row per class: its set and smallest
    id, its group's smallest id, and ``first`` for one class of each group."""
    small_batches(docs)
    slim = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    uid = F.col("_task").cast("long") * F.lit(1 << 40) + F.col("_place")
    rows = write_table(sketch(slim, "text", k, drop=("text",), number=True), "sketch")
    classes = stage(rows.filter("set_key IS NOT NULL").groupBy("set_key")
                    .agg(F.min(uid).alias("c"), F.min("id").alias("least_id"),
                         F.min(F.struct(F.col("id").isNull(), "id", "hash"))["hash"].alias("hash"),
                         F.first("signature").alias("signature")), "classes")
    least = _least_alike(percent / 100)

    buckets = _buckets(classes)
    sizes = stage(buckets.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = stage(buckets.join(sizes.withColumnRenamed("code", "in_code"), F.col("code") == F.col("in_code"))
                    .select("code", "n", "c"), "members")
    signatures = classes.select("c", "signature")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")
    signed = members.join(signatures, "c")
    tested = stage(_forest_pairs(signed.withColumn("block", F.pmod(F.xxhash64("c"), blocks)), least), "pairs")

    # whole texts of the classes in shared buckets: of each, a row with its smallest id, found by id and text hash
    wanted = members.select("c").distinct().join(classes.select("c", "least_id", F.col("hash").alias("of")), "c")
    texts = stage(slim.join(wanted, slim["id"].eqNullSafe(wanted["least_id"]) & (slim["hash"] == wanted["of"]))
                  .select("c", "text").dropDuplicates(["c"]), "texts")

    links = stage(_verified(tested, texts, k, percent), "links")
    groups = components(links)

    # round two: buckets that still hold several groups
    grouped = (members.join(groups.withColumnRenamed("a", "c"), "c", "left")
               .select("code", "n", "c", F.coalesce("b", "c").alias("g")))
    mixed = (grouped.groupBy("code").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
             .filter("lo <> hi").select("code"))
    grouped = stage(grouped.join(stage(mixed, "mixed"), "code", "left_semi"), "grouped")
    signed = grouped.join(signatures, "c")
    small = (signed.filter(F.col("n") <= BLOCK)
             .select("code", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "c", "g",
                     "signature", F.lit(True).alias("first"), F.lit(True).alias("second")))
    large = _block_pairs(signed.filter(F.col("n") > BLOCK), grouped.filter(F.col("n") > BLOCK))
    crossing = stage(_cross_members(small.unionByName(large), least), "crossing")
    links = stage(_cross_links(crossing, texts, k, percent, least), "links")
    groups = components(groups.union(links))

    # the smallest id of each group of classes, and its class with the smallest number
    linked = classes.select("c", "least_id", "set_key").join(
        groups.union(groups.select("b", "b").distinct()).toDF("c", "root"), "c")
    ids = linked.groupBy("root").agg(F.min("least_id").alias("group_id"),
                                     F.min(F.struct(F.col("least_id").isNull(), "least_id", "c"))["c"].alias("chosen"))
    named = linked.join(ids, "root").select(F.col("set_key").alias("linked_key"), "group_id",
                                            (F.col("c") == F.col("chosen")).alias("first"))
    return rows, stage(classes.join(named, F.col("set_key") == F.col("linked_key"), "left")
                       .select(F.col("set_key").alias("of_key"), "least_id",
                               F.coalesce("group_id", "least_id").alias("component_id"),
                               F.coalesce("first", F.lit(True)).alias("first")), "final")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, *, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``set_key``,
    ``component_id`` (the smallest id reachable over links) and ``kept``."""
    rows, final = _grouped(docs, k, percent, id_col, text_col)
    rows = rows.select(F.col("id").alias(id_col), "n_shingles", "set_key")
    some = (rows.filter("set_key IS NOT NULL").join(final.drop("least_id", "first"), F.col("set_key") == F.col("of_key"))
            .drop("of_key"))
    alone = rows.filter("set_key IS NULL").withColumn("component_id", F.col(id_col))
    return some.unionByName(alone).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _block_pairs(signed: DataFrame, grouped: DataFrame) -> DataFrame:
    """Members of large buckets dealt into block pairs (i, j): those outside the
    bucket's largest group in block i against all members in block j."""
    counts = grouped.groupBy("code", "g").agg(F.count("*").alias("of_g"))
    main = counts.groupBy("code").agg(F.max_by("g", F.struct("of_g", "g")).alias("main"),
                                      (F.sum("of_g") - F.max("of_g")).alias("outside"),
                                      F.sum("of_g").alias("n_all"))
    main = stage(main, "main").withColumnRenamed("code", "in_code")
    rows = signed.join(main, F.col("code") == F.col("in_code"))
    n_i, n_j = (F.ceil(F.col(x) / F.lit(BLOCK)).cast("long") for x in ("outside", "n_all"))
    zero = F.lit(0).cast("long")
    first = (rows.filter("g <> main")
             .withColumn("i", F.pmod(F.xxhash64("c"), n_i)).withColumn("j", F.explode(F.sequence(zero, n_j - 1)))
             .withColumn("first", F.lit(True)).withColumn("second", F.lit(False)))
    second = (rows.withColumn("j", F.pmod(F.xxhash64("g", "c"), n_j))
              .withColumn("i", F.explode(F.sequence(zero, n_i - 1)))
              .withColumn("first", F.lit(False)).withColumn("second", F.lit(True)))
    names = ["code", "i", "j", "c", "g", "signature", "first", "second"]
    return first.select(names).unionByName(second.select(names))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80, *, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, one with the
    smallest id; texts without words all stay. Same columns."""
    _, final = _grouped(docs, k, percent, id_col, text_col)
    kept = final.filter("first").select(F.col("least_id").alias("_id"), F.col("of_key").alias("_key"))
    names = docs.columns
    keyed = sketch(docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)]),
                   f"_c{names.index(text_col)}", k, signature=False)
    mine = f"_c{names.index(id_col)}"
    stay = (keyed.filter("set_key IS NOT NULL")
            .join(kept, keyed[mine].eqNullSafe(kept["_id"]) & (keyed["set_key"] == kept["_key"]), "left_semi")
            .dropDuplicates([mine, "set_key"]))
    return (gathered(stay).unionByName(keyed.filter("set_key IS NULL"))
            .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)]))
