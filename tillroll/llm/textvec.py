"""Words of many texts at once, as numpy arrays.

A byte table says which bytes are part of a word. Word hashes are polynomial
hashes mod 2**64 over the (possibly lower-cased) bytes, so one cumulative sum
per block gives the hash of every word and of every word prefix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class _Powers:
    def __init__(self) -> None:
        self.n = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, _BLOCK + 1)
            self.fwd, self.inv = _powers(self.n, _BASE), _powers(self.n, _INV)
        return self.fwd, self.inv


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base, or more, and of its inverse."""
    return _POWERS.get(n)


def byte_table(is_word, lower: bool = True) -> np.ndarray:
    """256 codes: 0 for separators, else 1 + the byte (A-Z folded)."""
    t = np.zeros(256, np.uint64)
    for b in range(256):
        if is_word(b):
            t[b] = 1 + (b + 32 if lower and 65 <= b <= 90 else b)
    return t


#: runs of ASCII digits and letters and of non-ASCII bytes
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: runs between spaces and the control characters 9 to 13
SPACED = byte_table(lambda b: not (b == 32 or 9 <= b <= 13))


@dataclass
class Words:
    start: np.ndarray  # byte offsets
    end: np.ndarray
    code: np.ndarray  # 64-bit hashes
    first: np.ndarray  # per text: index of its first word, and the total at the end
    prefixes: dict[int, np.ndarray] = field(default_factory=dict)  # 0 where shorter

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def scan_words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray,
               prefix_lengths: tuple[int, ...] = ()) -> Words:
    """Words of the texts ``raw[offsets[i]:offsets[i + 1]]``; memory follows
    the block size, or the longest unbroken word if that is longer."""
    starts, ends, codes = [], [], []
    prefixes: dict[int, list] = {k: [] for k in prefix_lengths}
    pos, n, size = 0, len(raw), _BLOCK
    inner = offsets[:-1]
    while pos < n:
        end = min(n, pos + size)
        coded = table[raw[pos:end]]
        if end < n:  # cut where no word is cut: after a separator or at a text's start
            gaps = np.flatnonzero(coded == 0)
            cut = pos + int(gaps[-1]) + 1 if gaps.size else pos
            cut = max(cut, int(inner[np.searchsorted(inner, end, side="right") - 1]))
            if cut <= pos:
                size *= 2
                continue
            end, coded = cut, coded[:cut - pos]
        size = _BLOCK
        word = coded != 0
        lo, hi = np.searchsorted(inner, [pos, end])
        at = inner[lo:hi] - pos
        before = np.empty_like(word)
        before[0] = False
        before[1:] = word[:-1]
        before[at] = False
        s = np.flatnonzero(word & ~before)
        last = np.empty_like(word)
        last[-1] = True
        last[:-1] = ~word[1:]
        last[at[at > 0] - 1] = True
        e = np.flatnonzero(word & last) + 1
        fwd, inv = _POWERS.get(end - pos + 1)
        total = np.zeros(end - pos + 1, np.uint64)
        np.cumsum(coded * fwd[:end - pos], out=total[1:])
        codes.append(mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64) * _M2))
        for k in prefix_lengths:
            long = e - s >= k
            p = np.zeros(len(s), np.uint64)
            p[long] = mix((total[s[long] + k] - total[s[long]]) * inv[s[long]] + np.uint64(k * int(_M1) % (1 << 64)))
            prefixes[k].append(p)
        starts.append(s + pos)
        ends.append(e + pos)
        pos = end
    join = lambda xs, dt: np.concatenate(xs) if xs else np.zeros(0, dt)
    start = join(starts, np.int64)
    return Words(start, join(ends, np.int64), join(codes, np.uint64),
                 np.searchsorted(start, offsets), {k: join(v, np.uint64) for k, v in prefixes.items()})


def runs_of(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive codes (order counts)."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = codes[:n].copy()
    for j in range(1, k):
        out = mix(out) + codes[j:j + n]
    return mix(out)


def shingles(words: Words, k: int) -> list[np.ndarray]:
    """Per text: sorted distinct hashes of its ``k``-word shingles; of fewer
    words, one hash of all of them; of none, an empty array."""
    every = runs_of(words.code, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= k:
            part = np.sort(every[a:b - k + 1])
            out.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
        elif b > a:
            out.append(runs_of(words.code[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
