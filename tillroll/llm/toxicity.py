"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a plain sample of all texts, labels
unseen, is the unlabelled set. With class prior p, the risk of a linear
classifier is  p*R+(positives) + max(0, R-(unlabelled) - p*R-(positives)):
the last part corrects the unlabelled risk for the positives hidden in it and
is kept from going negative, which stops overfitting.

Features are the presence of word hashes and of word-prefix hashes (4, 5 and
6 bytes), kept where positives and unlabelled texts differ most. Scoring is
map-only over whole texts.

The fit reads a bounded sample: at most ``most`` positives and ``2 * most``
unlabelled texts, in id-hash order. Rows of the held-out fold are never read
for labels. Defined results: null and empty texts score by the bias alone;
repeated label rows count once (toxic if any says so); without any positive,
every score is the prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, bounded_sample, crc_fold, slices_by_bytes, utf8
from tillroll.llm.textvec import ALNUM, scan_words

PREFIXES = (4, 5, 6)
_SLICE = 4 << 20
_BITS = 20


def _features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word and word prefix."""
    words = scan_words(raw, offsets, ALNUM, PREFIXES)
    text = words.text
    texts, codes = [text], [words.code]
    for k in PREFIXES:
        has = words.prefixes[k] != 0
        texts.append(text[has])
        codes.append(words.prefixes[k][has])
    return np.concatenate(texts), np.concatenate(codes)


@dataclass
class Model:
    codes: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def screen(self) -> np.ndarray:
        table = np.zeros(1 << _BITS, bool)
        table[(self.codes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        return table

    def score(self, raw: np.ndarray, offsets: np.ndarray, screen: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        z = np.full(n, self.bias)
        if len(self.codes):
            text, code = _features(raw, offsets)
            near = screen[(code >> np.uint64(64 - _BITS)).astype(np.int64)]
            text, code = text[near], code[near]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            pairs = np.unique(text[hit].astype(np.int64) * len(self.codes) + at[hit])  # presence
            np.add.at(z, pairs // len(self.codes), self.weights[pairs % len(self.codes)])
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _sample_features(rows: DataFrame) -> list[np.ndarray]:
    """Distinct feature hashes per sampled text, computed in tasks."""
    out = T.StructType([T.StructField("_codes", T.BinaryType())])

    def work():
        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index("text")))
            text, code = _features(raw, offsets)
            order = np.argsort(text, kind="stable")
            cuts = np.searchsorted(text[order], np.arange(1, len(offsets) - 1))
            return [[np.unique(x).tobytes() for x in np.split(code[order], cuts)][:b.num_rows]]

        return each

    return [np.frombuffer(r[0], np.uint64)
            for r in append_columns(rows, out, work).select("_codes").collect()]


def _matrix(codes: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(texts), len(codes)), np.float32)
    for i, t in enumerate(texts):
        at = np.minimum(np.searchsorted(codes, t), len(codes) - 1)
        out[i, at[codes[at] == t]] = 1.0
    return out


def select_features(pos: list[np.ndarray], unl: list[np.ndarray], most: int) -> np.ndarray:
    """The hashes whose document shares differ most, in standard errors; a hash
    must be in 3 positives, so one text alone decides nothing."""
    found, n_pos = np.unique(np.concatenate(pos), return_counts=True)
    found, n_pos = found[n_pos >= 3], n_pos[n_pos >= 3]
    other, n_unl = np.unique(np.concatenate(unl) if unl else np.zeros(0, np.uint64), return_counts=True)
    at = np.minimum(np.searchsorted(other, found), max(0, len(other) - 1))
    unl_count = np.where(other[at] == found, n_unl[at], 0) if len(other) else np.zeros(len(found))
    p, u = n_pos / len(pos), unl_count / max(1, len(unl))
    z = (p - u) / np.sqrt((p * (1 - p) + 1e-4) / len(pos) + (u * (1 - u) + 1e-4) / max(1, len(unl)))
    return np.sort(found[np.argsort(-z, kind="stable")[:most]])


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05,
             penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear score under the non-negative risk, by Adam
    on the logistic loss. Where the corrected part is negative, the step undoes
    it instead."""
    w, b = np.zeros(pos.shape[1]), np.log(prior / (1 - prior))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sig = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, steps + 1):
        w32 = w.astype(np.float32)
        zp, zu = (pos @ w32).astype(float) + b, (unl @ w32).astype(float) + b
        corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = (sig(zp) - 1) * prior / len(zp)  # of the positives' loss as positives
        down_u, down_p = sig(zu) / len(zu), -prior * sig(zp) / len(zp)
        if corrected >= 0:
            gp, gu = up + down_p, down_u
        else:
            gp, gu = -down_p, -down_u
        g = np.append(gp.astype(np.float32) @ pos + gu.astype(np.float32) @ unl + penalty * w,
                      gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, fold: int = 5, held_out: int = 0,
                 most: int = 3000, n_features: int = 512) -> Model:
    """Fit on confirmed toxic rows outside the held-out fold, and on texts
    drawn without regard to labels."""
    seen = (labels.filter(crc_fold("doc_id", fold) != held_out)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = seen.agg(F.avg("toxic")).first()[0]
    prior = min(0.9, max(1e-3, float(share or 0.0)))
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    texts = docs.select("doc_id", "text")
    pos = _sample_features(bounded_sample(texts, by_hash(seen.filter("toxic = 1").select("doc_id"), most), most))
    if not pos:
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    unl = _sample_features(bounded_sample(texts, by_hash(ids, 2 * most), 2 * most))
    codes = select_features(pos, unl, n_features)
    if not len(codes):
        return Model(codes, np.zeros(0), float(np.log(prior / (1 - prior))))
    w, b = fit_nnpu(_matrix(codes, pos), _matrix(codes, unl), prior)
    return Model(codes, w, b)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text",
                   out_col: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        m = shared.value
        screen = m.screen()

        def each(b):
            raw, offsets = utf8(b.column(b.schema.get_field_index(text_col)))
            out = [m.score(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], screen)
                   for lo, hi in slices_by_bytes(offsets, _SLICE)]
            return [np.concatenate(out) if out else np.zeros(0)]

        return each

    return append_columns(docs, T.StructType([T.StructField(out_col, T.DoubleType())]), work)
