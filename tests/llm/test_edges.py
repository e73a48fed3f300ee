"""Every operator on empty tables, repeated rows, null ids and columns that
clash with its own, in letter case too."""

import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontam, neardup, packing, quality, secrets, sharding, tokens, topk, toxicity, warc
from tillroll.session import shared_path

#: names of appended and inner columns
CLASHES = ("findings", "N_Words", "n_hit", "hit_items", "n_shingles", "component_id", "Kept", "score", "n_tokens", "start",
           "length", "ids", "offset", "sequence_id", "part", "upto", "base", "shard", "slot", "Curve", "c", "code", "block",
           "set_key", "signature", "id", "_task", "_place", "_text", "_clean", "_codes", "_own", "_first", "item_id", "toxic",
           "quality", "rank", "vec_id", "page_id", "url", "html", "embedding")
TEXT = "password = abcdefghijkl99 " + " ".join(f"w{i}" for i in range(40))
ROWS = [(1, None), (2, ""), (3, TEXT), (3, TEXT), (None, TEXT), (4, TEXT.upper()), (5, "w1 " * 20_000), (6, "\x00\n \U0001F600")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def bench(spark):
    df = spark.createDataFrame([(1, TEXT), (1, TEXT), (2, None)], "item_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c != "item_id"} | {"doc_id": F.lit(7)})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(3, 1, 0), (3, 1, 0), (4, 0, 1), (5, None, None), (None, 0, 1), (1, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


def _both(docs, work):
    """The result on the rows, after the same work on none of them."""
    assert work(docs.limit(0)).count() == 0
    return work(docs).collect()


def test_text_operators(docs, bench, labels):
    hit = _both(docs, lambda d: decontam.scan_benchmark(d, bench))
    assert sorted(r["n_hit"] > 0 for r in hit) == [False] * 4 + [True] * 4
    assert decontam.decontaminate(docs, bench, action="document").count() == 4
    assert decontam.decontaminate(docs, bench, action="span").count() == len(ROWS)
    near = _both(docs, lambda d: neardup.near_duplicates(d, k=5))
    assert sorted((r["doc_id"], r["component_id"]) for r in near if r["doc_id"]) == [
        (1, 1), (2, 2), (3, 3), (3, 3), (4, 3), (5, 5), (6, 6)]
    kept = _both(docs, lambda d: neardup.deduplicate(d, k=5))
    assert sorted(r["doc_id"] for r in kept) == [1, 2, 3, 5, 6]
    for fit, score in ((toxicity.fit_toxicity, toxicity.score_toxicity), (quality.fit_quality, quality.score_quality)):
        model = fit(docs, labels)
        got = _both(docs, lambda d: score(d, model))
        assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
        assert len(_both(docs, lambda d: score(d, fit(docs.limit(0), labels)))) == len(ROWS)
    found = _both(docs, secrets.scan_secrets)
    assert sum(len(r["findings"]) for r in found) == 4
    clean = _both(docs, secrets.redact)
    assert sum("[secret]" in (r["text"] or "") for r in clean) == 4 and sum(r["text"] is None for r in clean) == 1


def test_token_operators(docs):
    counts = {r["doc_id"]: r["n_tokens"] for r in _both(docs, tokens.count_tokens)}
    assert counts[1] == counts[2] == 0 and counts[3] == counts[None] and counts[5] >= 20_000
    pieces = _both(docs, packing.pack)
    assert sum(r["length"] for r in pieces) == sum(counts[i] + 1 for i, _ in ROWS)
    at = 0
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert 4096 * r["sequence_id"] + r["offset"] == at and len(r["ids"]) == 4 * r["length"]
        at += r["length"]


def test_shards(docs):
    got = _both(docs, lambda d: sharding.hilbert_shards(d, ["code", "doc_id"], shards=3))
    assert sorted(r["shard"] for r in got) == [0, 0, 0, 1, 1, 1, 2, 2] and got[0]["findings"] == "clash"


def test_vectors(spark):
    rows = [(0, [0.5, -0.25]), (0, [0.5, -0.25]), (1, [0.5, -0.25]), (2, None), (None, [1.0, 1.0]), (3, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    df = df.withColumns({c: F.lit("clash") for c in CLASHES if c not in ("vec_id", "embedding")} | {"Query_Id": F.lit(1)})
    got = _both(df, lambda d: topk.top_k(d, F.col("vec_id") % 50 == 0))
    # either copy of row 0 finds the other one and row 1
    score = 128 * 128 + 64 * 64
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(
        2 * [(0, 1, 0, score), (0, 2, 1, score)])


def test_archives(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", "x"), (3, "w", "x"), (4, "w", "y" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    df = df.withColumns({c: F.lit("clash") for c in CLASHES if c not in ("page_id", "url", "html")} | {"Payload": F.lit(1)})

    def work(pages):
        path = shared_path(spark, "warc-edges", unique=True)
        warc.write_warc(pages, path)
        return warc.resolve(warc.read_warc(spark, path))

    got = sorted((r["id"] or "", r["payload_bytes"], r["record_type"], r["refers_to"] or "") for r in _both(df, work))
    assert got == [("", 1, "revisit", "3"), ("1", 0, "response", ""), ("2", 0, "revisit", "1"), ("2", 0, "revisit", "1"),
                   ("3", 1, "response", ""), ("4", 300_000, "response", "")]
