"""Secret scans: patterns, and a token-efficiency test for random strings.

Three patterns give the base findings (assignments, access keys, hex strings).
The token-efficiency test adds spans: key characters that a tiktoken
vocabulary can only spell in short tokens (few characters per token) are random
text, as words and names are covered by longer tokens. Letters need no digits
among them. A run is measured whole, then in segments and stretches, so that
words beside a key do not hide it; what a base finding covers is not measured.
Known digests (hex of a digest's length) and UUIDs are left out.

Offsets are code points, the end is exclusive. Defined results: a null or
empty text has no findings; findings of one kind never overlap; a run longer
than 4,096 characters is measured in parts of that length, whole.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import append_columns

# fixed values: patterns, least lengths and the order of the kinds
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "random")

LEAST_RUN = 16
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN
LONG = 20  # shorter ones need a lower ratio, SHORT of the usual one
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)  # md5, sha1, sha224, sha256, sha384, sha512 in hex
CHARS_PER_TOKEN = 2.0
SHORT = 0.925
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEXRUN = re.compile(r"[0-9A-Fa-f]+")
_SIGN = re.compile(r"[+/_=-]")
SPLIT = "/=_-"
_SEGMENT = re.compile(r"[A-Za-z0-9+]{%d,}" % LEAST_RUN)
_KNOWN = re.compile("(?<![A-Za-z0-9])(?:%s)(?![A-Za-z0-9])" % "|".join(
    [_UUID.pattern, *("[0-9A-Fa-f]{%d}" % n for n in DIGEST_LENGTHS)]))

OUT = T.StructType([T.StructField("findings", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())])))])


def _maximal(score: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring stretches (Ruzzo and Tompa), in linear time."""
    found: list[tuple[float, float, int, int, int]] = []  # sums before and after, start, end, nearest lower one
    total = 0.0
    for k, s in enumerate(score):
        total += s
        if s <= 0:
            continue
        low, start, j = total - s, k, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                break
            low, start, up = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = up
        found.append((low, total, start, k + 1, j))
    return [f[2:4] for f in found]


class Scanner:
    """Findings of one text at a time, with batch-wide screens in front."""

    def __init__(self, vocabulary: str, chars_per_token: float) -> None:
        # ASCII: case folding stays within A-Z
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        # a run of hex digits is maximal either way, so the least length may sit in the pattern
        self.hex = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])
        self.run = re.compile(RUN)
        self.vocabulary, self.chars_per_token, self.encoding = vocabulary, chars_per_token, None

    def tokens(self, run: str) -> list[int]:
        """Characters of each token of an ASCII run."""
        if self.encoding is None:
            import public_tokenizers as P
            import tiktoken

            with open(self.vocabulary, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("scan", pat_str=P.PATTERN, mergeable_ranks=ranks,
                                              special_tokens={})
            self.sizes = {i: len(t) for t, i in ranks.items()}
        return [self.sizes[t] for i in range(0, len(run), 4096) for t in self.encoding.encode_ordinary(run[i:i + 4096])]

    def is_random(self, run: str) -> bool:
        letters = sum(map(str.isalpha, run))
        if not letters or _UUID.fullmatch(run) or (len(run) in DIGEST_LENGTHS and _HEXRUN.fullmatch(run)):
            return False
        sizes = self.tokens(run)
        if len(run) >= LONG and any(map(str.isdigit, run)):
            return len(run) < self.chars_per_token * len(sizes)
        # letters alone and short runs: signs between words are tokens too, so they do not count
        signs = len(_SIGN.findall(run))
        return self.is_dense(len(run), signs, letters, len(self.tokens(_SIGN.sub(" ", run)) if signs else sizes))

    def is_dense(self, size: int, signs: int, letters: int, tokens: int) -> bool:
        """The test without signs: ``size`` characters with the signs, ``tokens`` without."""
        least = self.chars_per_token * (1 if size >= LONG else SHORT)
        return 8 * signs <= size and 6 * letters >= size and size - signs < least * tokens

    def stretches(self, text: str, a: int, b: int) -> list[tuple[int, int]]:
        """Random parts of ``text[a:b]``, key characters that hold no finding: segments
        between signs, and stretches of short tokens widened to whole segments."""
        spans, at = [], a
        for lo, hi in [*(m.span() for m in _KNOWN.finditer(text, a, b)), (b, b)]:
            if lo - at >= LEAST_RUN:
                spans += [m.span() for m in _SEGMENT.finditer(text, at, lo) if self.is_random(m[0])]
                spans += self.short_tokens(text, at, lo)
            at = hi
        merged = []
        for lo, hi in sorted(spans):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        return merged

    def short_tokens(self, text: str, a: int, b: int) -> list[tuple[int, int]]:
        ends = list(accumulate(self.tokens(text[a:b]), initial=a))
        signs = [_SIGN.match(text, x) is not None for x in ends[:-1]]  # no token holds both
        score = [0.0 if sign else self.chars_per_token - (y - x) for sign, x, y in zip(signs, ends, ends[1:])]
        spans = []
        for i, j in _maximal(score):
            lo, hi = ends[i], ends[j]
            if hi - lo < LEAST_RUN:
                continue
            n = sum(y - x for sign, x, y in zip(signs[i:j], ends[i:j], ends[i + 1:j + 1]) if sign)
            if self.is_dense(hi - lo, n, sum(map(str.isalpha, text[lo:hi])), j - i - sum(signs[i:j])):
                while lo > a and text[lo - 1] not in SPLIT:
                    lo -= 1
                while hi < b and text[hi] not in SPLIT:
                    hi += 1
                spans.append((lo, hi))
        return spans

    def text(self, text: str, screens: tuple[bool, ...]) -> list[tuple[str, int, int]]:
        found = []
        if screens[0]:
            found += [("assign", *m.span()) for m in self.assign.finditer(text)
                      if len(m[2]) >= LEAST["assign"]]
        if screens[1]:
            found += [("access", *m.span()) for m in self.access.finditer(text)
                      if m.end() - m.start() >= LEAST["access"]]
        if screens[2]:
            found += [("hex", *m.span()) for m in self.hex.finditer(text)]
        if screens[3]:
            base = sorted((a, b) for _, a, b in found)
            starts = [a for a, _ in base]
            ends = list(accumulate((b for _, b in base), max))  # of all findings so far
            for m in self.run.finditer(text):
                a, b = m.span()
                # findings that end after the run's start and start before its end
                inside = range(bisect_right(ends, a), bisect_left(starts, b))
                if not inside and self.is_random(m[0]):
                    found.append(("random", a, b))
                    continue
                for i in inside:
                    found += [("random", *x) for x in self.stretches(text, a, starts[i])]
                    a = max(a, ends[i])
                found += [("random", *x) for x in self.stretches(text, a, b)]
        found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
        return found

    def batch(self, texts: pa.Array) -> list[list]:
        texts = texts.fill_null("") if texts.null_count else texts
        # linear-time screens over the Arrow buffers; each lets through a superset
        screens = [pc.match_substring_regex(texts, p).to_pylist() for p in (
            r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", r"AKIA[A-Z0-9]",
            r"[0-9a-f]{16}", r"[A-Za-z0-9+/_=-]{16}")]
        out = []
        for i, marks in enumerate(zip(*screens)):
            out.append(self.text(texts[i].as_py(), marks) if any(marks) else [])
        return out


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def scan_secrets(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None,
                 chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with ``findings``: (kind, start, end) by start, then kind."""
    vocabulary = vocabulary or _vocabulary()

    def work():
        scanner = Scanner(vocabulary, chars_per_token)

        def each(b):
            found = scanner.batch(b.column(b.schema.get_field_index(text_col)))
            return [[[{"kind": k, "start": a, "end": e} for k, a, e in f] for f in found]]

        return each

    return append_columns(docs, OUT, work)


def joined(findings, kinds: tuple[str, ...] = KINDS):
    """``kind:start:end`` of the findings of ``kinds``, comma-joined."""
    chosen = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]",
           vocabulary: str | None = None, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with every finding replaced by ``mark``; overlapping findings
    share one mark. Other texts stay as they are."""
    vocabulary = vocabulary or _vocabulary()

    def work():
        scanner = Scanner(vocabulary, chars_per_token)

        def each(b):
            texts = b.column(b.schema.get_field_index(text_col))
            return [[_redacted(t.as_py(), f, mark) for t, f in zip(texts, scanner.batch(texts))]]

        return each

    name = "_" + max(docs.columns, key=len)  # no column has it
    clean = append_columns(docs, T.StructType([T.StructField(name, T.StringType())]), work, drop=(text_col,))
    return clean.withColumnRenamed(name, text_col).select(*[F.col(f"`{c}`") for c in docs.columns])


def _redacted(text: str | None, findings: list[tuple], mark: str) -> str | None:
    if not findings:
        return text
    out, pos, until = [], 0, -1
    for _, start, end in findings:  # by start
        if start >= until:
            out += [text[pos:start], mark]
        until = pos = max(until, end)
    return "".join([*out, text[pos:]])
