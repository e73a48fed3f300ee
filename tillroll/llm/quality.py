"""Quality: a linear-chain conditional random field over the lines of a text.

Every line gets a label, good or bad, from its own and its neighbours'
features (letter case, symbols, separators, repeated words and lines, lengths).
Forward-backward gives each line's marginal; a text's raw quality is the mean
marginal of "good", weighted by line length. A monotone map, fitted on the same
sample, puts the best cut at the decision threshold.

Only texts carry labels, so lines start with their text's label; after a first
fit, lines of bad texts that the model itself finds good are relabelled (a bad
text keeps at least one bad line) and the field is fitted once more.

The fit reads a bounded sample: at most ``most`` texts of either label, in
id-hash order, none of the held-out fold; longer texts are fitted as
consecutive chains of 64 lines (scoring uses whole texts). Defined results: null and empty texts
are one empty line; repeated label rows count once (bad if any says so); with
only one label seen, all texts get that label's side of the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, bounded_sample, crc_fold, slices_by_bytes, utf8
from tillroll.llm.textvec import byte_table, mix, scan_words

_SLICE = 2 << 20
_WORD = byte_table(lambda b: not (b == 32 or 9 <= b <= 13), lower=False)
_UPPER, _LOWER, _DIGIT, _BAR, _BANG, _SYMBOL, _POINT = range(1, 8)
N_OWN = 12
_CHAIN = 64  # lines of one training chain
_BLOCK = 256  # lines of a scored chain that are stepped through one by one


def _classes() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[65:91], t[97:123], t[128:], t[48:58] = _UPPER, _LOWER, _LOWER, _DIGIT
    for chars, k in ((b"|", _BAR), (b"!?", _BANG), (b"#$%&*^~<>\\{}[]", _SYMBOL), (b".,;:'\"()-", _POINT)):
        t[list(chars)] = k
    return t


_CLASS = _classes()


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line, line lengths in bytes, and per text the
    index of its first line (and the total at the end). A text has one line
    more than line feeds."""
    n_texts = len(offsets) - 1
    feeds = np.flatnonzero(raw == 10)
    # a line starts at each text's start and after each line feed
    text_of_feed = np.searchsorted(offsets, feeds, side="right") - 1
    per_text = np.bincount(text_of_feed, minlength=n_texts) + 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    start = np.zeros(first[-1], np.int64)
    end = np.zeros(first[-1], np.int64)
    is_first = np.zeros(first[-1], bool)
    is_first[first[:-1]] = True
    start[is_first], start[~is_first] = offsets[:-1], feeds + 1
    is_last = np.zeros(first[-1], bool)
    is_last[first[1:] - 1] = True
    end[is_last], end[~is_last] = offsets[1:], feeds
    size = end - start

    kind = _CLASS[raw]
    count = np.zeros((8, len(start)))
    some = np.flatnonzero(size > 0)
    if some.size:
        edges = np.empty(2 * some.size, np.int64)
        edges[::2], edges[1::2] = start[some], end[some]
        cut = edges[:-1] if edges[-1] >= len(raw) else edges
        for k in range(1, 8):
            count[k, some] = np.add.reduceat(kind == k, cut, dtype=np.int64)[::2]

    words = scan_words(raw, offsets, _WORD)
    line = np.searchsorted(start, words.start, side="right") - 1  # empty lines hold no word
    n_words = np.bincount(line, minlength=len(start)).astype(float)
    same = np.zeros(len(words.code), bool)
    if len(same) > 1:
        same[1:] = (words.code[1:] == words.code[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line[same], minlength=len(start))
    # a line's hash: its words in order, by position
    place = np.arange(len(words.code)) - np.searchsorted(words.start, start)[line]
    whole = np.zeros(len(start), np.uint64)
    np.add.at(whole, line, mix(words.code + place.astype(np.uint64)))
    text = np.repeat(np.arange(n_texts), per_text)
    _, back, times = np.unique(mix(whole) + mix(text.astype(np.uint64) + np.uint64(7)),
                               return_inverse=True, return_counts=True)
    again = (times[back] > 1) & (n_words > 0)

    w, letters = np.maximum(n_words, 1), np.maximum(count[_UPPER] + count[_LOWER], 1)
    own = np.stack([
        np.log1p(size) / 5, count[_UPPER] / letters, count[_DIGIT] / np.maximum(size, 1),
        np.minimum(count[_SYMBOL] / w, 4) / 2, np.minimum(count[_BAR] / w, 1),
        np.minimum(count[_BANG] / w, 4) / 2, np.minimum(count[_POINT] / w, 2),
        np.minimum(letters / w, 30) / 10, np.maximum(repeats - 1, 0) / w, again.astype(float),
        (n_words <= 2).astype(float), (size == 0).astype(float)], axis=1)
    return own, size, first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0 at a text's ends), and 1."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    some = first[:-1][np.diff(first) > 0]
    before[some] = 0
    after[first[1:][np.diff(first) > 0] - 1] = 0
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1)


def forward_backward(unary: np.ndarray, first: np.ndarray, trans: np.ndarray,
                     enter: np.ndarray | None = None, leave: np.ndarray | None = None):
    """Marginals per line, summed transition marginals, and per-text log Z of
    two-state chains; ``unary`` and ``trans`` are log potentials. ``enter`` and
    ``leave`` are messages from the lines before and behind each chain, where it is a
    part of a longer one (the sums are then of no use)."""
    n = len(unary)
    top = unary.max(axis=1, keepdims=True) if n else unary
    local, step = np.exp(unary - top), np.exp(trans)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    fwd, scale, bwd = np.zeros((n, 2)), np.ones(n), np.ones((n, 2))
    if leave is not None:
        bwd[first[1:] - 1] = leave
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # texts longer than t
    for t in range(longest):
        at = begin[:active[t]] + t
        a = local[at] * (fwd[at - 1] @ step if t else 1.0 if enter is None else enter[order])
        s = a.sum(axis=1)
        fwd[at], scale[at] = a / s[:, None], s
    both = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        ahead = local[at + 1] * bwd[at + 1]
        bwd[at] = (ahead @ step.T) / scale[at + 1][:, None]
        both += step * (fwd[at].T @ (ahead / scale[at + 1][:, None]))
    marg = fwd * bwd
    marg /= np.maximum(marg.sum(axis=1, keepdims=True), 1e-300)
    return marg, both, float(np.log(scale).sum() + top.sum())


def long_marginals(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, block: int = _BLOCK) -> np.ndarray:
    """The marginals of ``forward_backward`` in about ``3 * block`` vector steps and two for
    every ``block`` lines of the longest chain. Chains are cut into blocks and the
    transfer matrices of all blocks are composed at once; messages go from block to
    block, and each block is solved with the two it gets. Exact up to rounding."""
    length = np.diff(first)
    if not len(length) or length.max() <= block:
        return forward_backward(unary, first, trans)[0]
    n_blocks = -(-length // block)
    head = np.cumsum(n_blocks) - n_blocks  # a chain's first block
    place = np.arange(n_blocks.sum()) - np.repeat(head, n_blocks)
    begin = np.repeat(first[:-1], n_blocks) + place * block
    cuts = np.append(begin, first[-1])
    local, step = np.exp(unary - unary.max(axis=1, keepdims=True)), np.exp(trans)
    across = np.tile(np.eye(2), (len(begin), 1, 1))  # from the line before a block to its last one
    for t in range(block):
        on = np.flatnonzero(np.diff(cuts) > t)
        here = local[begin[on] + t]
        line = step * here[:, None, :]
        if t == 0:  # no step leads to a chain's first line
            line[place == 0] = np.eye(2) * here[place == 0][:, None, :]
        line = across[on] @ line
        across[on] = line / line.max(axis=(1, 2), keepdims=True)
    enter, leave, last = np.ones((len(begin), 2)), np.ones((len(begin), 2)), np.ones((len(begin), 2))
    for k in range(int(n_blocks.max()) - 1):
        at = head[n_blocks > k + 1] + k
        m = np.einsum("bi,bij->bj", last[at - 1] if k else last[at], across[at])
        last[at] = m / m.max(axis=1, keepdims=True)
        enter[at + 1] = last[at] @ step
    for k in range(int(n_blocks.max()) - 2, -1, -1):
        at = head[n_blocks > k + 1] + k
        m = np.einsum("bij,bj->bi", across[at + 1], leave[at + 1])
        leave[at] = m / m.max(axis=1, keepdims=True)
    return forward_backward(unary, cuts, trans, enter, leave)[0]


@dataclass
class Model:
    weights: np.ndarray  # of "good" against "bad", per feature
    trans: np.ndarray  # log potentials, from bad/good to bad/good
    cut: float  # raw quality at the decision threshold
    threshold: float
    constant: float | None = None  # the score where only one label was seen

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        unary = np.zeros((len(x), 2))
        unary[:, 1] = x @ self.weights
        return long_marginals(unary, first, self.trans)[:, 1]

    def raw_quality(self, own, size, first) -> np.ndarray:
        good = self.marginals(with_neighbours(own, first), first)
        weight = size + 1.0
        return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        q = self.raw_quality(*line_features(raw, offsets))
        c, t = self.cut, self.threshold
        return np.clip(np.where(q < c, t * q / c, t + (1 - t) * (q - c) / (1 - c)), 0, 1)


def fit_field(x: np.ndarray, first: np.ndarray, good: np.ndarray, steps: int = 200, rate: float = 0.15,
              penalty: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by Adam on the penalised log-likelihood."""
    n, k = len(x), x.shape[1]
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[to - 1].astype(int), good[to].astype(int)), 1)
    w, m, v = np.zeros(k + 4), np.zeros(k + 4), np.zeros(k + 4)
    for step in range(1, steps + 1):
        unary = np.zeros((n, 2))
        unary[:, 1] = x @ w[:k]
        marg, both, _ = forward_backward(unary, first, w[k:].reshape(2, 2))
        g = np.append(x.T @ (marg[:, 1] - good), (both - seen).ravel()) / n + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:k], w[k:].reshape(2, 2)


def best_cut(q: np.ndarray, good: np.ndarray) -> float:
    """The middle of the gap that parts good from bad with fewest errors,
    either label weighing the same in all."""
    order = np.argsort(q, kind="stable")
    q, good = q[order], good[order]
    wrong_below = np.concatenate([[0], np.cumsum(good)]) / max(1, good.sum())
    wrong_above = np.concatenate([np.cumsum((~good)[::-1])[::-1], [0]]) / max(1, (~good).sum())
    edges = np.concatenate([[0.0], q, [1.0]])
    wide = edges[1:] - edges[:-1]
    cost = wrong_below + wrong_above
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    i = best[np.argmax(wide[best])]
    return float(np.clip((edges[i] + edges[i + 1]) / 2, 0.01, 0.99))


def _sampled_lines(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    out = T.StructType([T.StructField("_own", T.BinaryType()), T.StructField("_size", T.BinaryType())])

    def work():
        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index("text")))
            own, size, first = line_features(raw, offsets)
            cut = list(zip(first[:-1], first[1:]))
            return [[own[a:e].astype(np.float32).tobytes() for a, e in cut],
                    [size[a:e].astype(np.int64).tobytes() for a, e in cut]]

        return each

    return [(np.frombuffer(r[0], np.float32).reshape(-1, N_OWN).astype(float), np.frombuffer(r[1], np.int64))
            for r in append_columns(rows, out, work).select("_own", "_size").collect()]


def fit_quality(docs: DataFrame, labels: DataFrame, *, fold: int = 4, held_out: int = 2,
                most: int = 2000, threshold: float = 0.7) -> Model:
    """Fit the field on labelled rows outside the held-out fold."""
    seen = (labels.filter(crc_fold("doc_id", fold) != held_out)
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    texts, lines, marks = docs.select("doc_id", "text"), [], []
    for mark in (0, 1):
        ids = (seen.filter(F.col("quality") == mark).select("doc_id")
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
        got = _sampled_lines(bounded_sample(texts, ids, most))
        lines += got
        marks += [bool(mark)] * len(got)
    good_text = np.array(marks, bool)
    none = np.zeros(3 * N_OWN + 1), np.zeros((2, 2)), 0.5, threshold
    if good_text.all() or not good_text.any():
        return Model(*none, constant=0.0 if len(marks) and not good_text.any() else 1.0)
    own, size = np.concatenate([a for a, _ in lines]), np.concatenate([s for _, s in lines])
    count = np.array([len(s) for _, s in lines])
    first = np.concatenate([[0], np.cumsum(count)])
    x, label = with_neighbours(own, first), np.repeat(good_text, count)
    chains = np.unique(np.concatenate([np.arange(a, b, _CHAIN) for a, b in zip(first[:-1], first[1:])] + [first[-1:]]))
    model = Model(*fit_field(x, chains, label.astype(float)), 0.5, threshold)
    found = model.marginals(x, first)
    worst = np.repeat(np.minimum.reduceat(found, first[:-1]), count)
    label = label | ((found > 0.5) & (found > worst))
    model = Model(*fit_field(x, chains, label.astype(float)), 0.5, threshold)
    model.cut = best_cut(model.raw_quality(own, size, first), good_text)
    return model


def score_quality(docs: DataFrame, model: Model, text_col: str = "text",
                  out_col: str = "score") -> DataFrame:
    """``docs`` with the quality score of each whole text (map-only)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        m = shared.value

        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index(text_col)))
            out = [m.score(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                   for lo, hi in slices_by_bytes(offsets, _SLICE)]
            return [np.concatenate(out) if out else np.zeros(0)]

        return each

    return append_columns(docs, T.StructType([T.StructField(out_col, T.DoubleType())]), work)
