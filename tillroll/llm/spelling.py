"""Groups of spelling variants, found in a trie of letter counts.

1. Words are counted in tasks and summed up; the vocabulary is a staged table.
2. Every word has a frequency vector: its length, then how often each letter group
   occurs. The commonest letters are groups of their own, the others share some.
   The words stand in a trie by these counts, one level for each.
3. Depth-first search with a budget: at each level a word may go to the child of
   its own count, to one with one letter more (surplus) or, afterwards, to one with one
   less (deficit). A word of equal length spends both or neither; one that is a letter
   longer has a surplus only. Each pair is so found from one side: the
   shorter word, or the one whose first difference is a surplus.
4. At a leaf, one changed letter leaves one half of a word as it is, so only words with an
   equal half are verified, letter by letter. Pairs of a leaf are not listed.
5. The trie is spread: its top, down to nodes of a bounded number of words,
   is known to all tasks; the rest of each branch is searched in one task, to which the
   words are dealt whose search enters it. The top has at most ``_BRANCHES``
   nodes with more words than the bound on each level, whatever the vocabulary's size.

Levels of the search are arrays over many words at once.

Defined results: null and empty texts have no words; repeated rows count again;
a null id counts as ''; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import complete_groups, small_batches, stage, tidied, utf8
from tillroll.llm.textvec import mix, powers

RUN = re.compile("[A-Za-zÀ-ÿ]+")
OWN, SHARED = 15, 5  # letters with a group of their own; groups of the other letters
_BRANCHES = 20_000
_LEAST = 1000  # words of a branch that is not divided
_WIDE = 32  # longer words are verified one by one
_FLUSH = 200_000  # words that a task counts before it passes them on
#: states of a search: equal length, with nothing, a surplus, or both spent; longer, with nothing or the surplus spent
_EQUAL, _OWED, _PAID, _LONGER, _GROWN = range(5)


def count_words(docs: DataFrame, *, shortest: int = 7, id_col: str = "doc_id", text_col: str = "text",
                change: Callable[[str, bytes], str] | None = None) -> DataFrame:
    """(word, n): lower-cased (A-Z) runs of letters of at least ``shortest``
    code points in all texts. ``change`` rewrites a run of a document, given the id as text."""
    runs = re.compile(RUN.pattern[:-1] + "{%d,}" % shortest)
    small_batches(docs)

    @tidied
    def run(batches):
        count: Counter = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                             names=["word", "n"])
            count.clear()
            return got

        for b in batches:
            raw, at = utf8(b.column(1))
            for lo, hi, i in zip(at[:-1].tolist(), at[1:].tolist(), b.column(0).to_pylist()):
                found = runs.findall(raw[lo:hi].tobytes().lower().decode())
                if change:
                    key = b"" if i is None else str(i).encode()
                    for word, n in Counter(found).items():
                        word = change(word, key)
                        if len(word) >= shortest:
                            count[word] += n
                else:
                    count.update(found)
                if len(count) > _FLUSH:
                    yield out()
        yield out()

    parts = docs.select(id_col, text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each letter (all are below U+0100), and word offsets."""
    raw, at = utf8(column)
    lead = raw == 0xC3
    letter = np.where((raw & 0xC0) == 0x80, raw + np.uint8(0x40), raw)[~lead]
    return letter, np.concatenate([[0], np.cumsum(~lead)])[at]


def vectors(letter: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Length and letter-group counts of every word; ``group``: of each letter."""
    n, groups = len(at) - 1, int(group.max()) + 1
    of = np.repeat(np.arange(n), np.diff(at))
    count = np.bincount(of * groups + group[letter], minlength=n * groups).reshape(n, groups)
    return np.concatenate([np.diff(at)[:, None], count], axis=1)


class Trie:
    """Levels of a trie over rows of ``columns``, which are sorted here.
    ``row[k]`` to ``row[k + 1]`` are the rows at leaf k; ``order`` sorts them."""

    def __init__(self, columns: np.ndarray) -> None:
        self.order = np.lexsort(columns.T[::-1])
        columns = columns[self.order]
        self.keys: list[np.ndarray] = []
        node = np.zeros(len(columns), np.int64)
        for c in columns.T:
            key = (node << 32) | c
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            self.keys.append(key[new])
            node = np.cumsum(new) - 1
        self.leaf = node
        self.row = np.searchsorted(node, np.arange(int(node[-1]) + 2 if len(node) else 1))


def _child(keys: np.ndarray, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes by their counts, and which of them exist."""
    key = (node << 32) | count
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return at, keys[at] == key


def _step(keys: np.ndarray, count: np.ndarray, q: np.ndarray, node: np.ndarray, state: np.ndarray, is_length: bool):
    """One level of the search for all (word, node, state): own count, surplus, deficit."""
    more = np.flatnonzero(state == _EQUAL if is_length else (state == _EQUAL) | (state == _LONGER))
    less = np.zeros(0, np.int64) if is_length else np.flatnonzero((state == _OWED) & (count[q] > 0))
    grown = np.full(len(more), _LONGER) if is_length else np.where(state[more] == _EQUAL, _OWED, _GROWN)
    q2 = np.concatenate([q, q[more], q[less]])
    add = np.repeat([0, 1, -1], [len(q), len(more), len(less)])
    state = np.concatenate([state, grown, np.full(len(less), _PAID)])
    child, there = _child(keys, np.concatenate([node, node[more], node[less]]), count[q2] + add)
    return q2[there], child[there], state[there]


class Top:
    """The top of the whole trie: nodes of many words, and their children.
    ``levels``: for each level the paths of the nodes there, and which are divided."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.child, self.branch, number = [], [], 0
        parent = np.zeros((1, 0), np.int64)
        for paths, divided in levels:
            order = np.lexsort(paths.T[::-1])
            paths, divided = paths[order], divided[order]
            place = {tuple(p): i for i, p in enumerate(parent.tolist())}
            of = np.array([place[tuple(p)] for p in paths[:, :-1].tolist()], np.int64)
            keys = (of << 32) | paths[:, -1]
            # a divided node goes on as the k-th of its kind, another is a branch of its own
            self.child.append((keys, divided, np.cumsum(divided) - 1, number + np.cumsum(~divided) - 1))
            number += int((~divided).sum())
            parent = paths[divided]

    def branches(self, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, branch, whether it is the word's own) of every branch that a search enters."""
        q = np.arange(len(vec))
        node, state = np.zeros(len(vec), np.int64), np.full(len(vec), _EQUAL)
        out = []
        for level, (keys, divided, goes_on, branch) in enumerate(self.child):
            q2, child, state = _step(keys, vec[:, level], q, node, state, level == 0)
            ends = ~divided[child]
            # the path on which nothing is spent is the word's own
            out.append(np.stack([q2[ends], branch[child[ends]], state[ends] == _EQUAL], axis=1))
            q, node, state = q2[~ends], goes_on[child[~ends]], state[~ends]
        every = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return every[:, 0], every[:, 1], every[:, 2].astype(bool)


def _halves(letter: np.ndarray, at: np.ndarray, longer: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and last part of every word, as long as the halves of
    a word of its length or, if ``longer``, of one letter less."""
    fwd, inv = powers(len(letter) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letter + np.uint64(1)) * fwd[:len(letter)], dtype=np.uint64)])
    size = np.diff(at) - longer
    lo, hi = at[:-1], at[1:]
    mid, back = lo + size // 2, hi - (size - size // 2)
    return mix((total[mid] - total[lo]) * inv[lo]), mix((total[hi] - total[back]) * inv[back])


def _one_apart(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether words (rows of letters, 0 behind) differ by one letter: replaced
    if they are equally long, else inserted in ``b``."""
    differ = a != b
    equal = la == lb
    out = equal & (differ.sum(axis=1) == 1)
    grown = np.flatnonzero(~equal)
    if grown.size:
        first = differ[grown].argmax(axis=1)
        moved = a[grown, :-1] != b[grown, 1:]
        moved &= np.arange(a.shape[1] - 1) < la[grown, None]
        last = np.where(moved.any(axis=1), a.shape[1] - 2 - moved[:, ::-1].argmax(axis=1), -1)
        out[grown] = last < first
    return out


def _is_one_apart(a: bytes, b: bytes) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:]


def _wide(letter: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of the first letters of every word, 0 behind."""
    size = np.minimum(np.diff(at), _WIDE)
    out = np.zeros((len(size), _WIDE), np.uint8)
    inside = np.arange(_WIDE) < size[:, None]
    out[inside] = letter[(at[:-1, None] + np.arange(_WIDE))[inside]]
    return out


def near_pairs(branch: np.ndarray, own: np.ndarray, letter: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """(i, j) of all words one letter apart where j stands in a branch (``own``)
    and i is dealt to it. Every pair comes once."""
    vec = vectors(letter, at, group)
    word = np.flatnonzero(own)
    if not word.size:
        return np.zeros((0, 2), np.int64)
    trie = Trie(np.concatenate([branch[word, None], vec[word]], axis=1))
    word = word[trie.order]
    size = np.diff(at)
    sides = []  # by length of the partner, then first or last part: sorted keys and the words in that order
    for longer in (False, True):
        each = []
        for part in _halves(letter, at, longer):
            key = mix(part[word] + trie.leaf.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(key, kind="stable")
            each.append((key[order], word[order]))
        sides.append(each)
    mine = _halves(letter, at, False)
    wide, out = _wide(letter, at), []
    for lo in range(0, len(branch), 20_000):
        q = np.arange(lo, min(len(branch), lo + 20_000))
        node, there = _child(trie.keys[0], np.zeros(len(q), np.int64), branch[q])
        q, node = q[there], node[there]
        state = np.full(len(q), _EQUAL)
        for level in range(vec.shape[1]):
            q, node, state = _step(trie.keys[level + 1], vec[:, level], q, node, state, level == 0)
        for longer in (False, True):
            at_end = (state == _GROWN) if longer else (state == _EQUAL) | (state == _PAID)
            x, leaf, spent = q[at_end], node[at_end].astype(np.uint64), state[at_end] != _EQUAL
            for part, (keys, words) in zip(mine, sides[longer]):
                key = mix(part[x] + leaf * np.uint64(0x9E3779B97F4A7C15))
                a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                n = b - a
                i = np.repeat(x, n)
                j = words[np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                # words of one vector meet from both sides
                out.append(np.stack([i, j, np.repeat(~spent, n)], axis=1)[i != j])
    pair = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)
    i, j = pair[:, 0], pair[:, 1]
    good = np.zeros(len(pair), bool)
    short = np.maximum(size[i], size[j]) < _WIDE
    for lo in range(0, len(pair), 1 << 18):
        k = slice(lo, lo + (1 << 18))
        good[k] = short[k] & _one_apart(wide[i[k]], wide[j[k]], size[i[k]], size[j[k]])
    for k in np.flatnonzero(~short).tolist():
        x, y = (letter[at[w]:at[w + 1]].tobytes() for w in (i[k], j[k]))
        good[k] = _is_one_apart(x, y)
    twice = np.flatnonzero(good & (pair[:, 2] == 1))
    good[twice] = [letter[at[x]:at[x + 1]].tobytes() < letter[at[y]:at[y + 1]].tobytes() for x, y in pair[twice, :2].tolist()]
    return pair[good, :2]


def _groups_of_letters(vocabulary: DataFrame) -> np.ndarray:
    """Group of every letter, by how many words' letters it is. 256 numbers."""
    @tidied
    def run(batches):
        n = np.zeros(256, np.int64)
        for b in batches:
            n += np.bincount(letters_of(b.column(0))[0], minlength=256)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["letter", "n"])

    counted = vocabulary.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    group = np.full(256, OWN + SHARED - 1, np.int64)
    ranked = sorted(counted.collect(), key=lambda r: (-r["n"], r["letter"]))
    for k, r in enumerate(ranked):
        group[r["letter"]] = k if k < OWN else OWN + (k - OWN) % SHARED
    return group


def _top(vocabulary: DataFrame, group: np.ndarray, bound: int) -> Top:
    """Nodes of more than ``bound`` words and their children, level by level."""
    levels, divided, depth = [], {()}, OWN + SHARED + 1
    for level in range(depth):
        @tidied
        def run(batches, level=level, divided=frozenset(divided)):
            count: Counter = Counter()
            for b in batches:
                vec = vectors(*letters_of(b.column(0)), group)[:, :level + 1]
                paths, n = np.unique(vec, axis=0, return_counts=True)
                for p, k in zip(map(tuple, paths.tolist()), n.tolist()):
                    if p[:-1] in divided:
                        count[p] += k
            yield pa.RecordBatch.from_arrays([pa.array(list(map(list, count)), pa.list_(pa.int64())),
                                              pa.array(list(count.values()), pa.int64())], names=["path", "n"])

        rows = (vocabulary.select("word").mapInArrow(run, "path array<long>, n long")
                .groupBy("path").agg(F.sum("n").alias("n")).collect())
        if not rows:
            break
        large = np.array([r["n"] > bound for r in rows]) & (level + 1 < depth)
        levels.append((np.array([r["path"] for r in rows], np.int64), large))
        divided = {tuple(r["path"]) for r, x in zip(rows, large) if x}
        if not divided:
            break
    return Top(levels)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): every word of ``vocabulary`` (word, n; distinct) with each
    word one letter apart, in both directions."""
    small_batches(vocabulary)
    total = vocabulary.count()
    group = _groups_of_letters(vocabulary)
    top = vocabulary.sparkSession.sparkContext.broadcast(_top(vocabulary, group, max(_LEAST, total // _BRANCHES)))

    @tidied
    def deal(batches):
        for b in batches:
            q, branch, own = top.value.branches(vectors(*letters_of(b.column(0)), group))
            yield pa.RecordBatch.from_arrays([pa.array(branch), pa.array(own), b.column(0).take(pa.array(q)),
                                              b.column(1).take(pa.array(q))], names=["branch", "own", "word", "n"])

    @tidied
    def search(batches):
        for t, _ in complete_groups(batches, ["branch"]):
            t = t.combine_chunks()
            word, n = t.column("word").combine_chunks(), t.column("n").combine_chunks()
            letter, at = letters_of(word)
            pair = near_pairs(t.column("branch").to_numpy(), t.column("own").to_numpy(zero_copy_only=False), letter, at, group)
            for lo in range(0, len(pair), 1 << 17):
                i, j = (pa.array(x) for x in pair[lo:lo + (1 << 17)].T)
                for x, y in ((i, j), (j, i)):
                    yield pa.RecordBatch.from_arrays([word.take(x), word.take(y), n.take(y)], names=["word", "near", "near_n"])

    dealt = vocabulary.select("word", "n").mapInArrow(deal, "branch long, own boolean, word string, n long")
    return (dealt.repartition("branch").sortWithinPartitions("branch")
            .mapInArrow(search, "word string, near string, near_n long"))


def group_variants(words: DataFrame, *, least: int = 2, ratio: int = 10) -> DataFrame:
    """Of ``words`` (word, n) those with n of ``least`` or more, each with ``n_near``,
    ``form`` (its near word of largest n, ties to the smallest, if that n is at least
    ``ratio`` times its own; else null), ``form_n`` and ``root``: the last word that forms lead to."""
    if ratio < 2:
        raise ValueError("forms lead to an end only if n grows")
    vocabulary = stage(words.filter(F.col("n") >= least), "vocabulary")
    near = (near_words(vocabulary).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")))
    held = F.col("best.m") * F.lit(-1) >= F.col("n") * F.lit(ratio)
    formed = stage(vocabulary.join(near, "word", "left").select(
        "word", F.when(held, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(held, -F.col("best.m")).alias("form_n")), "forms")
    # n grows by the ratio at each step, so chains are short; every round doubles the step
    reach = formed.filter("form IS NOT NULL").select(F.col("word").alias("at"), F.col("form").alias("root"))
    while True:
        ahead = reach.select(F.col("at").alias("root"), F.col("root").alias("next"))
        joined = stage(reach.join(ahead, "root", "left").select("at", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "roots")
        reach = joined.select("at", "root")
        if joined.filter("moved").isEmpty():
            break
    return (formed.join(reach.withColumnRenamed("at", "word"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
