"""Token counts and token ids of whole texts under a public tokenizer file.

Arrow batches of texts are encoded in tasks and only lengths (or ids) come
back. Texts are cut at spaces and line feeds, which no token of the supported
tokenizer spans: it drops white space and matches words between. So the ids of
a text are the ids of its pieces in order. Each distinct piece is handed to the
tokenizer once, in batches balanced by bytes; a bounded table of pieces, by
64-bit hash, is kept by the worker. Batches are worked off in slices of some
bytes, and a longer text is cut at such a boundary first, so memory follows the
slice.

Special strings inside a text are handled as the library does by default
(they hold no white space, so they never span pieces). Null counts as empty;
an empty text has no tokens.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns, slices_by_bytes, utf8
from tillroll.llm.textvec import byte_table, scan_words

_SLICE = 2 << 20  # text bytes worked off at once
_BATCH_BYTES = 1 << 17  # text bytes handed to the tokenizer at once
_KEPT = 500_000  # pieces remembered by a worker
_PIECE = byte_table(lambda b: b not in (10, 32), lower=False)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_parts(raw: np.ndarray, most: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Byte ranges of one text of about ``most`` bytes, cut behind a space or
    line feed; a longer stretch without one stays whole."""
    lo, n = 0, len(raw)
    while n - lo > most:
        gaps = np.flatnonzero(_PIECE[raw[lo:lo + most]] == 0)
        if gaps.size:
            cut = lo + int(gaps[-1]) + 1
        else:
            cut, size = n, most
            for at in range(lo + most, n, size):
                gaps = np.flatnonzero(_PIECE[raw[at:at + size]] == 0)
                if gaps.size:
                    cut = at + int(gaps[0]) + 1
                    break
        yield lo, cut
        lo = cut
    yield lo, n


class Encoder:
    """Ids of pieces, or only their number; remembers up to ``_KEPT`` pieces."""

    def __init__(self, path: str, only_lengths: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        whole = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.single_word]
        self.mark, self.mark_id = whole[0] if whole else ("", -1)
        self.only_lengths = only_lengths
        self.codes = np.zeros(0, np.uint64)  # sorted
        self.uses = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)  # into ids
        self.ids, self.used = np.zeros(0, np.uint32), 0

    def _make_room(self) -> None:
        """Keep the pieces used most, half of the table at most, and none used
        once; older uses count half from now on."""
        most = _KEPT // 2
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > most:
            kept = np.sort(kept[np.argpartition(self.uses[kept], -most)[-most:]])
        self.codes, self.uses, count = self.codes[kept], self.uses[kept] // 2, self.count[kept]
        if not self.only_lengths:
            ends = np.cumsum(count)
            self.ids = self.ids[np.repeat(self.start[kept] - ends + count, count) + np.arange(int(count.sum()))]
            self.used, self.start = len(self.ids), ends - count
        else:
            self.start = self.start[kept]
        self.count = count

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token count of every piece, and all ids. Pieces are handed over as one
        text with a special string between them, which the tokenizer cuts out
        before anything else; where a piece holds that string, one by one."""
        count, ids, lo, held = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], 0, 0
        for i, p in enumerate(pieces):
            held += len(p) + 8
            if held < _BATCH_BYTES and i + 1 < len(pieces):
                continue
            group, lo, held = pieces[lo:i + 1], i + 1, 0
            text = self.mark.join(group)
            if self.mark and text.count(self.mark) == len(group) - 1:
                got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                at = np.flatnonzero(got == self.mark_id)
                count.append(np.diff(np.concatenate([[-1], at, [len(got)]])) - 1)
                ids.append(np.delete(got, at))
            else:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                count.append(np.array([len(x) for x in each], np.int64))
                ids.append(np.array([t for x in each for t in x], np.uint32))
        return np.concatenate(count), np.concatenate(ids)

    def _learn(self, codes: np.ndarray, pieces: list[str]) -> None:
        """Add pieces by their (sorted, unknown) codes."""
        count, ids = self._encode(pieces)
        if self.only_lengths:
            start = np.zeros(len(count), np.int64)
        else:
            total = len(ids)
            if self.used + total > len(self.ids):
                grown = np.zeros(max(2 * len(self.ids), self.used + total, 1 << 16), np.uint32)
                grown[:self.used] = self.ids[:self.used]
                self.ids = grown
            start = self.used + np.cumsum(count) - count
            self.ids[self.used:self.used + total] = ids
            self.used += total
        at = np.searchsorted(self.codes, codes)
        self.codes = np.insert(self.codes, at, codes)
        self.uses = np.insert(self.uses, at, 0)
        self.count = np.insert(self.count, at, count)
        self.start = np.insert(self.start, at, start)

    def _look_up(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the table, and whether it is known."""
        at = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
        return at, (self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool))

    def slice(self, raw: np.ndarray, offsets: np.ndarray) -> list:
        """Per text: its token count, or its ids as little-endian uint32."""
        words = scan_words(raw, offsets, _PIECE)
        codes, where, back = np.unique(words.code, return_index=True, return_inverse=True)
        at, known = self._look_up(codes)
        if not known.all():
            if len(self.codes) + int((~known).sum()) > _KEPT:
                self._make_room()
                _, known = self._look_up(codes)
            new = where[~known]
            data = raw.tobytes()
            self._learn(codes[~known], [data[a:b].decode() for a, b in
                                        zip(words.start[new].tolist(), words.end[new].tolist())])
            at, _ = self._look_up(codes)
        if len(codes):
            self.uses[at] += np.bincount(back, minlength=len(codes))
        count = self.count[at][back] if len(codes) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(count)])
        border = ends[words.first]
        if self.only_lengths:
            return np.diff(border).tolist()
        first = self.start[at][back] if len(codes) else np.zeros(0, np.int64)
        ids = self.ids[np.repeat(first - ends[:-1], count) + np.arange(ends[-1])].astype("<u4")
        return [ids[a:b].tobytes() for a, b in zip(border[:-1].tolist(), border[1:].tolist())]

    def over(self, raw: np.ndarray, offsets: np.ndarray) -> list:
        out: list = []
        for lo, hi in slices_by_bytes(offsets, _SLICE):
            part = raw[offsets[lo]:offsets[hi]]
            if hi == lo + 1 and len(part) > _SLICE:
                each = [self.slice(part[a:b], np.array([0, b - a]))[0] for a, b in safe_parts(part)]
                out.append(sum(each) if self.only_lengths else b"".join(each))
            else:
                out += self.slice(part, offsets[lo:hi + 1] - offsets[lo])
        return out


_ENCODERS: dict = {}


def encoder(path: str, only_lengths: bool) -> Encoder:
    """One encoder per worker process, file and kind; workers are reused."""
    key = (path, only_lengths)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, only_lengths)
    return _ENCODERS[key]


def count_tokens(docs: DataFrame, path: str | None = None, text_col: str = "text",
                 out_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each whole text in ``out_col``."""
    path = path or tokenizer_path()
    out = T.StructType([T.StructField(out_col, T.LongType())])

    def work():
        enc = encoder(path, True)
        return lambda b: [enc.over(*utf8(b.column(b.schema.get_field_index(text_col))))]

    return append_columns(docs, out, work)


def token_ids(docs: DataFrame, path: str | None = None, text_col: str = "text",
              out_col: str = "ids", end_id: int | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text as little-endian uint32 bytes,
    followed by ``end_id`` if given."""
    path = path or tokenizer_path()
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    out = T.StructType([T.StructField(out_col, T.BinaryType())])

    def work():
        enc = encoder(path, False)

        def each(b):
            found = enc.over(*utf8(b.column(b.schema.get_field_index(text_col))))
            return [pa.array([x + tail for x in found], pa.binary())]

        return each

    return append_columns(docs, out, work)


def over_limit(counts: DataFrame, most: int = 2048, count_col: str = "n_tokens") -> DataFrame:
    return counts.withColumn("over_limit", F.col(count_col) > F.lit(most))
