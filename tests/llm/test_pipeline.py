"""The pipeline: every stage's decisions over the whole input."""

import re

import corpus_pipeline as P
from tillroll.llm import decontam, neardup, quality, queries
from tillroll.llm.common import stage

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score_quality(docs, model).filter("score >= 0.7").collect()}
    a = stage(P.quality_stage(spark, docs, SF), "a")
    assert a.columns == COLUMNS and {r[0] for r in a.collect()} == good
    b = stage(P.near_duplicate_stage(spark, a, SF), "b")
    kept = {r[0] for r in neardup.near_duplicates(a, 5).filter("kept").collect()}
    assert b.columns == COLUMNS and sorted(r[0] for r in b.collect()) == sorted(kept)
    c = stage(P.decontamination_stage(spark, b, SF), "c")
    assert c.columns == COLUMNS and decontam.scan_benchmark(c, bench).filter("n_hit > 0").count() == 0
    assert c.count() == decontam.scan_benchmark(b, bench).filter("n_hit = 0").count()
    d = stage(P.secret_stage(spark, c, SF), "d")
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in (c, d))
    assert d.columns == COLUMNS and before.keys() == after.keys()
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"]) and not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r["text"])
        assert "[secret]" in r["text"] or r["text"] == before[i]["text"]
    e = P.packing_stage(spark, d, SF)
    assert {r[0] for r in e.select("doc_id").collect()} == after.keys()


def test_odd_documents(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "x y " * 9, "en", None, 36),
            (3, "x y " * 9, "en", None, 36), (None, "x y " * 9, "en", None, 36), (4, 'token = "' + "ab12" * 10 + '"', "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in P.STAGES[1:4]:
        docs = stage(step(spark, docs, SF), "odd")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    assert got == [(False, 1, ""), (False, 2, ""), (False, 2, ""), (False, 3, "x y " * 9), (False, 4, '[secret]"')]
    for _, step in P.STAGES:  # also the quality stage
        assert step(spark, docs.limit(0), SF).count() == 0
    scored = P.quality_stage(spark, spark.createDataFrame(rows, docs.schema).selectExpr("*", "0 AS Score"), SF)
    assert scored.columns == [*docs.columns, "Score"] and scored.count() <= len(rows)
    assert P.packing_stage(spark, docs, SF).count() == 5
    assert P.packing_stage(spark, docs.limit(0), SF).count() == 0


def test_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
