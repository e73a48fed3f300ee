"""Repeated strings, spelling variants and periodic runs against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import periodic, queries, repeats, spelling

DOC = "doc_id long, text string, KEPT string, chunk string, row string, id string, word string, runs string"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], DOC).repartition(3)


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(120):
        span = rng.choice([1, 2, 3, 5, 6, 8])
        texts = list(dict.fromkeys(bytes(rng.choice(b"ab\xf4") if rng.random() < .9 else 0 for _ in range(rng.randint(span, 30)))
                                   for _ in range(rng.randint(1, 30))))
        ids = np.array([rng.randint(0, 50) for _ in texts])
        at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        got = repeats.smallest_ids(np.frombuffer(b"".join(texts), np.uint8), at, ids, span)
        least: dict = {}
        for x, i in zip(texts, ids.tolist()):
            for s in range(len(x) - span + 1):
                least[x[s:s + span]] = min(least.get(x[s:s + span], 99), i)
        for row, x in zip(got, texts):
            want = [least[x[s:s + span]] for s in range(len(x) - span + 1)]
            assert row[:len(want)].tolist() == want


def test_suffix_order_of_wide_symbols(monkeypatch):
    # five bytes a symbol: a text of 80 bytes takes 16 rounds, in spite of more five-byte strings than numbers
    rng = np.random.default_rng(4)
    rounds = []
    build = repeats.Collection
    monkeypatch.setattr(repeats, "Collection", lambda symbol, at, *rest: rounds.append(int(np.diff(at).max())) or build(symbol, at, *rest))
    source = rng.integers(0, 256, 200_000).astype(np.uint8).tobytes()
    for many, span in ((1500, 50), (40, 10)):
        texts = [source[a:a + n] for a, n in zip(rng.integers(0, 200_000 - 80, many).tolist(), rng.integers(span, 81, many).tolist())]
        texts = list(dict.fromkeys([*texts, *[x[5:] + b"tail" for x in texts[::3] if len(x) > span + 4], *[x[:span] for x in texts[::7]]]))
        ids = np.arange(len(texts))[::-1].copy()
        got = repeats.smallest_ids(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])]), ids, span)
        least: dict = {}
        for x, i in zip(texts, ids.tolist()):
            for s in range(len(x) - span + 1):
                least[x[s:s + span]] = min(least.get(x[s:s + span], i), i)
        for row, x in zip(got, texts):
            assert row[:len(x) - span + 1].tolist() == [least[x[s:s + span]] for s in range(len(x) - span + 1)]
    assert max(rounds) <= 16


def _brute_repeats(rows, span):
    first: dict = {}
    texts = [((t or "").encode(), 1 << 62 if i is None else i) for i, t in rows]
    for x, i in texts:
        for s in range(len(x) - span + 1):
            w = x[s:s + span]
            first[w] = min(first.get(w, 1 << 63), i)
    out = []
    for x, i in texts:
        gone = [False] * len(x)
        for s in range(len(x) - span + 1):
            if first[x[s:s + span]] < i:
                gone[s:s + span] = [True] * span
        spans, k = [], 0
        while k < len(x):
            e = k
            while e < len(x) and gone[e]:
                e += 1
            if e > k:
                spans.append((k, e))
            k = max(e, k + 1)
        out.append((spans, bytes(c for c, g in zip(x, gone) if not g)))
    return out


@pytest.mark.parametrize("span,gram,hot", [(50, 20, 4096), (50, 20, 3), (11, 4, 4096), (11, 4, 9)])
def test_remove_repeats(spark, span, gram, hot):
    rng = random.Random(span)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    vocabulary = [word() for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    line = prose(14)
    rows = [(i, prose(rng.randint(1, 60))) for i in range(60)]
    rows += [(i, prose(10) + " " + line + " " + prose(10)) for i in range(60, 160)]  # a line that many share
    rows += [(i, rows[i % 7][1]) for i in range(160, 200)] + [(3, rows[3][1]), (3, rows[4][1] + "!")]
    rows += [(None, rows[5][1]), (None, line), (200, None), (201, ""), (202, "ab " * 3000), (203, "ab " * 2000),
             (-7, line + line), (204, "é" * 49), (205, "é" * 60), (206, rows[9][1][3:])]
    want = Counter((i, tuple(spans), kept) for (i, _), (spans, kept) in zip(rows, _brute_repeats(rows, span)))
    docs = _docs(spark, rows)
    got = repeats.remove_repeats(docs, span=span, gram=gram, chunk_bytes=4000, hot=hot).collect()
    assert Counter((r["doc_id"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in got) == want
    assert all(r["n_bytes"] - r["n_removed"] == len(r["kept"]) for r in got)
    assert repeats.remove_repeats(docs.limit(0), span=span, gram=gram).count() == 0


def test_hot_anchor_segments():
    """Segments cut into single strings give the same answers."""
    rng = random.Random(8)
    common = "".join(rng.choice("abcdefgh ") for _ in range(40)).encode()
    texts = list({bytes(rng.choice(b"xyz") for _ in range(20)) + common + bytes(rng.choice(b"xyz") for _ in range(20))
                  for _ in range(50)})
    at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    raw, ids = np.frombuffer(b"".join(texts), np.uint8), np.arange(len(texts))
    whole = repeats.smallest_ids(raw, at, ids, 44)
    pieces = {}
    for i, x in enumerate(texts):
        for s in range(len(x) - 43):
            pieces[x[s:s + 44]] = min(pieces.get(x[s:s + 44], 99), i)
    alone = repeats.smallest_ids(np.frombuffer(b"".join(pieces), np.uint8), np.arange(0, 44 * len(pieces) + 1, 44),
                                 np.array(list(pieces.values())), 44)[:, 0]
    answer = dict(zip(pieces, alone.tolist()))
    for row, x in zip(whole, texts):
        assert row[:len(x) - 43].tolist() == [answer[x[s:s + 44]] for s in range(len(x) - 43)]


def _brute_variants(v, ratio):
    near = defaultdict(set)
    same = defaultdict(set)
    for w in v:
        for i in range(len(w)):
            same[i, w[:i] + w[i + 1:], len(w)].add(w)
            if (d := w[:i] + w[i + 1:]) in v:
                near[w].add(d)
                near[d].add(w)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        form[w] = best if best and v[best] >= ratio * v[w] else None
    out = {}
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, v[w], len(near[w]), v[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("alphabet,n,longest,least", [("abc", 500, 9, 40), ("aeinorst", 3000, 10, 200), ("aabé×ÿ", 200, 45, 10)])
def test_variants(spark, monkeypatch, alphabet, n, longest, least):
    monkeypatch.setattr(spelling, "_LEAST", least)  # more branches
    rng = random.Random(n)
    v = {}
    for _ in range(n):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, longest)))
        v[w] = rng.choice([2, 3, 30, 400, 5000])
        i = rng.randrange(len(w))
        x = w[:i] + rng.choice([rng.choice(alphabet), ""]) + w[i + rng.choice([0, 1]):]
        v[x] = rng.choice([1, 2, 40, 900, 20000])
    df = spark.createDataFrame(list(v.items()), "word string, n long").repartition(5)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.group_variants(df).collect()}
    assert got == _brute_variants({w: k for w, k in v.items() if k >= 2}, 10)
    assert spelling.group_variants(df.limit(0)).count() == 0


def test_words_are_counted(spark):
    rows = [(1, None), (2, ""), (3, "Straßes GARDENS gardens1gardens, Éléphant éléphant short"), (3, "gardens"), (3, "gardens"),
            (None, "gardens " * 1000), (4, "x" * 100_000)]
    got = {r["word"]: r["n"] for r in spelling.count_words(_docs(spark, rows)).collect()}
    assert got == {"straßes": 1, "gardens": 1005, "Éléphant": 1, "éléphant": 1, "x" * 100_000: 1}
    changed = spelling.count_words(_docs(spark, rows), change=lambda w, i: w[1:] if i == b"3" else w)
    assert {r["word"]: r["n"] for r in changed.collect()}["gardens"] == 1000
    assert spelling.count_words(_docs(spark, rows[:2])).count() == 0


def _brute_runs(x):
    n, out = len(x), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                s, size = i, j - i + q
                if not any(all(x[s + t] == x[s + t + p] for t in range(size - p)) for p in range(1, q)):
                    out.add((s, q, size))
            i = max(j, i + 1)
    return [(s, size, q) for s, q, size in sorted(out)]


def test_word_runs():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(0, 4)):
            x = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 60))]
            while rng.random() < .6 and x:
                s, p = rng.randrange(len(x)), rng.randint(1, 9)
                x = x[:s] + x[s:s + p] * rng.randint(2, 7) + x[s + rng.randint(0, p):]
            docs.append(x[:200])
        first = np.concatenate([[0], np.cumsum([len(x) for x in docs])]).astype(np.int64)
        got = periodic.word_runs(np.array([w for x in docs for w in x], np.int64), first)
        for k, x in enumerate(docs):
            assert [tuple(r[1:]) for r in got.tolist() if r[0] == k] == _brute_runs(x)
    with pytest.raises(ValueError):
        periodic.word_runs(np.zeros(9, np.int64), np.array([0, 9]), least=3)


def test_find_runs(spark):
    rows = [(1, None), (2, ""), (3, "\t\n "), (4, "a b " * 5), (4, "a b " * 5), (None, "x y z"), (5, "w " * 50_000),
            (6, "p q " * 6 + "end"), (7, " ".join(f"w{i % 900}" for i in range(4000)))]
    got = {}
    for r in periodic.find_runs(_docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == got[2] == got[3] == [(0, [], "")] and got[None] == [(3, [], "x y z")]
    assert got[4] == 2 * [(10, [(0, 10, 2)], "a b")] and got[5] == [(50_000, [(0, 50_000, 1)], "w")]
    assert got[6] == [(7, [(0, 6, 1)], "p q end")]
    assert got[7][0][:2] == (4000, [(0, 4000, 900)]) and len(got[7][0][2].split()) == 900
    assert periodic.find_runs(_docs(spark, rows).limit(0)).count() == 0


def test_planted_changes():
    assert queries.repeated_tail([], b"1") == [] and queries.repeated_tail([b"a"], b"") == [b"a"]
    for i in range(200):
        words = [str(k).encode() for k in range(i)]
        assert len(queries.repeated_tail(words, str(i).encode())) == i
        run = "abcdefgh"
        assert len(queries.one_letter_less(run, str(i).encode())) in (7, 8)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
