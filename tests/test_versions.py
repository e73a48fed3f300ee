"""Variants, array files in splits, versions of files, checked loads, keyed state."""

import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import StructType

from tillroll.functions import catalog
from tillroll.operators import quality, variants
from tillroll.plans import jobs
from tillroll.session import settings, shared_path
from tillroll.sinks import files, versions
from tillroll.sources import split_json
from tillroll.streaming import once


def test_absent_is_not_null(spark):
    rows = [(1, '{"a": 1, "b": null}'), (2, '{"b": {"c": []}}'), (3, "{"), (4, None), (5, "null"), (6, '{"a": "x"}')]
    df = variants.to_variant(spark.createDataFrame(rows, "id int, text string"), "text")
    got = {r["id"]: (r["a"], r["b"]) for r in df.select("id", variants.state("document", "$.a").alias("a"),
                                                       variants.state("document", "$.b").alias("b")).collect()}
    assert got == {1: ("present", "null"), 2: ("absent", "present"), 3: ("malformed",) * 2, 4: ("malformed",) * 2,
                   5: ("absent", "absent"), 6: ("present", "absent")}
    typed = variants.fields(df, "document", {"n": ("$.a", "int")})
    assert {r["id"]: r["n"] for r in typed.collect()} == {1: 1, 2: None, 3: None, 4: None, 5: None, 6: None}
    assert "b" in variants.document_schema(df, "document").first()[0]
    assert variants.field_states(df.limit(0), "document", ["$.a"]).count() == 0


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split_bytes", [40, 1000, None])
def test_array_files_in_splits(spark, tmp_dir, indent, split_bytes):
    docs = [{"k": i, "t": ['a,"b]', "\\", "x\\\"],[{", "é\n,", "", "[[{{"][i % 6], "v": [{"w": j} for j in range(i % 4)]} for i in range(120)]
    texts = {"one.json": docs[:100], "sub/two.json": docs[100:], "empty.json": [], "last.json": []}
    for name, part in texts.items():
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, name)), exist_ok=True)
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("" if name == "last.json" else json.dumps(part, indent=indent, ensure_ascii=False))
    schema = "k int, t string, v array<struct<w:int>>"
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(schema)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = split_json.read_json_array(spark, tmp_dir, schema, split_bytes=split_bytes)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    rows = sorted((r["k"], r["t"], [x["w"] for x in r["v"]]) for r in got.collect())
    assert rows == [(d["k"], d["t"], [x["w"] for x in d["v"]]) for d in docs]


def test_array_files_round_trip_and_malformed(spark, tmp_dir):
    df = spark.createDataFrame([(i, f'q"{i}],', i % 2) for i in range(50)], "k int, t string, f int")
    path = os.path.join(tmp_dir, "arrays")
    split_json.write_json_arrays(df, path, "f")
    for name in ("f=0", "f=1"):
        pass
    folders = sorted(d for d in os.listdir(path) if "=" in d)
    assert folders == ["file=0", "file=1"]
    for d in folders:
        (part,) = [p for p in os.listdir(os.path.join(path, d)) if p.endswith(".txt")]
        assert len(json.load(open(os.path.join(path, d, part)))) == 25
    assert split_json.read_json_array(spark, path, df.select("k", "t").schema, split_bytes=64).count() == 50
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "x.json"), "w") as f:
        f.write('[{"k": 1}, {"k": oops}]')
    with pytest.raises(Exception):
        split_json.read_json_array(spark, bad, df.select("k").schema).collect()


def test_array_files_join_whole_elements_in_their_split(spark, tmp_dir):
    # the windows over all pieces are staged: the plan that is left puts only the splits' ends in order
    df = spark.createDataFrame([(i, "[{,\"" * (i % 3), i % 2) for i in range(200)], "k int, t string, f int")
    path = os.path.join(tmp_dir, "arrays")
    split_json.write_json_arrays(df, path, "f")
    back = split_json.read_json_array(spark, path, df.select("k", "t").schema, split_bytes=500)
    assert sorted(back.collect()) == sorted(df.select("k", "t").collect())
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


def test_array_files_are_written_from_one_pass(spark, tmp_dir):
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 3).alias("f"))
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    split_json.write_json_arrays(df.mapInArrow(look, df.schema), os.path.join(tmp_dir, "arrays"), "f")
    assert seen.value == 40


def _disk(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, found in os.walk(path) for f in found)


def test_array_files_are_read_without_a_copy_of_their_text(spark, tmp_dir):
    # a field that the schema leaves out, of a text that no compression makes much smaller
    noise = F.concat(*[F.sha2(F.concat(F.col("k").cast("string"), F.lit(str(j))), 512) for j in range(8)])
    df = spark.range(3000).select(F.col("id").alias("k")).select("k", noise.alias("noise"), (F.col("k") % 2).alias("f"))
    path = os.path.join(tmp_dir, "arrays")
    split_json.write_json_arrays(df, path, "f")
    base = shared_path(spark, "tables").removeprefix("file://").removeprefix("file:")
    before = _disk(base)
    back = split_json.read_json_array(spark, path, df.select("k").schema, split_bytes=1 << 16)
    assert sorted(r["k"] for r in back.collect()) == list(range(3000))
    assert _disk(base) - before < _disk(path) / 10


def test_array_files_text_is_written_after_the_shuffles(spark, tmp_dir, monkeypatch):
    plans = []
    text = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: plans.append(self._df) or text(self, *a, **k))
    dirs = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f for top in dirs for _, _, found in os.walk(top) for f in found if f.startswith("shuffle_")}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    df = spark.range(2000).repartition(7, "id").select(F.col("id").alias("k"), (F.col("id") % 5).alias("f"))
    base = shared_path(spark, "tables").removeprefix("file://").removeprefix("file:")
    held = _disk(base)
    split_json.write_json_arrays(df, os.path.join(tmp_dir, "arrays"), "f")
    assert _disk(base) - held < 2000  # the dealt documents are gone, but for an empty file
    (body,) = plans
    plan = body._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # of rows that are dealt to their files already
    assert "Sort [file" in plan and not body.schema["file"].nullable  # a name that may be NULL would have the text sorted again
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)  # they are dropped in the background
    assert not shuffled() - before
    assert spark.conf.get(key) == was


@pytest.mark.parametrize("rows", [1, 7])
def test_array_files_in_splits_of_several_batches(spark, tmp_dir, rows):
    docs = [{"k": i, "t": ["}", "\\", '}],\\"{', '"', "]}, "][i % 5], "v": [{"w": j} for j in range(i % 3)]} for i in range(90)]
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        json.dump(docs, f, indent=1)
    schema = StructType.fromDDL("k int, t string, v array<struct<w:int>>")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        got = split_json.read_json_array(spark, tmp_dir, schema, split_bytes=900).collect()
    assert sorted((r["k"], r["t"], [x["w"] for x in r["v"]]) for r in got) == [(d["k"], d["t"], [x["w"] for x in d["v"]]) for d in docs]


@pytest.mark.parametrize("text", ['[{"k": 1}, {"k": 2}', '[{"k": 1', '[{"k": 1}, {"k": "'])
def test_array_file_cut_off_fails(spark, tmp_dir, text):
    with open(os.path.join(tmp_dir, "x.json"), "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        split_json.read_json_array(spark, tmp_dir, StructType.fromDDL("k int")).collect()


def test_array_files_of_no_name_are_one(spark, tmp_dir):
    df = spark.createDataFrame([(i, [None, "", "a"][i % 3]) for i in range(30)], "k int, f string")
    path = os.path.join(tmp_dir, "arrays")
    split_json.write_json_arrays(df, path, "f")
    found = {d: [p for p in os.listdir(os.path.join(path, d)) if p.endswith(".txt")] for d in os.listdir(path) if "=" in d}
    assert {d: [len(json.load(open(os.path.join(path, d, p)))) for p in parts] for d, parts in found.items()} == {
        "file=__HIVE_DEFAULT_PARTITION__": [20], "file=a": [10]}


def _shop(spark, path, n=1200):
    """Orders and items in the driver's columns; some orders have no item."""
    k = F.col("id")
    spark.range(n).select(k.alias("o_orderkey"), (k % 7).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "OFP")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
                          (k * 1.5).cast("double").alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"),
                          F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{path}/orders.parquet")
    spark.range(3 * n).select((k % (n - 5)).alias("l_orderkey"), (k % 4).cast("int").alias("l_linenumber"), (k % 9).cast("double").alias("l_quantity"),
                              (k % 5).cast("double").alias("l_extendedprice"),
                              F.date_add(F.lit("2024-01-02").cast("date"), (k % 11).cast("int")).cast("timestamp_ntz").alias("l_shipdate")
                              ).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_split_json_deals_many_orders_into_several_files(spark, tmp_dir, monkeypatch):
    from tillroll.plans import q_versions

    sf, written = _shop(spark, tmp_dir), []
    write = split_json.write_json_arrays
    monkeypatch.setattr(split_json, "write_json_arrays", lambda *a: written.append(a[1]) or write(*a))
    whole = files.fingerprint(q_versions.q_split_json(spark, sf)).first()
    monkeypatch.setattr(q_versions, "ORDERS_A_FILE", 400)
    assert files.fingerprint(q_versions.q_split_json(spark, sf)).first() == whole
    few, many = (len([d for d in os.listdir(p.removeprefix("file://").removeprefix("file:")) if "=" in d]) for p in written)
    assert few < many


def test_update_rewrites_touched_files_only(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    df = spark.range(0, 1000, 1, 10).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(0).alias("stamp"))
    versions.create(df, root)
    before = {r[0] for r in versions.file_list(spark, root).collect()}
    batch = spark.createDataFrame([(5, None), (950, "new"), (5000, "nowhere")], "k long, v string")
    assert versions.update(spark, root, df.schema, batch, "k", "stamp", F.lit(7)) == 1
    after = {r[0] for r in versions.file_list(spark, root).collect()}
    assert len(before & after) == 8 and len(before) == 10  # untouched files keep their names
    now = {r["k"]: (r["v"], r["stamp"]) for r in versions.read(spark, root, df.schema).collect()}
    assert len(now) == 1000 and now[5] == (None, 7) and now[950] == ("new", 7) and now[6] == ("old", 0)
    assert versions.read(spark, root, df.schema, 0).filter("stamp = 7").count() == 0  # the old version is still there
    none = spark.createDataFrame([(7777, "x")], "k long, v string")
    assert versions.update(spark, root, df.schema, none, "k", "stamp", F.lit(8)) == 1
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string")
    with pytest.raises(Exception, match="duplicate key"):
        versions.update(spark, root, df.schema, twice, "k", "stamp", F.lit(8))
    assert versions.latest(spark, root) == 1 and versions.read(spark, root, df.schema).count() == 1000


FIELDS = [("k", "int"), ("n", "int"), ("s", "string")]


def test_dirty_lines_are_kept(spark, tmp_dir):
    lines = ["1|12x|O", "2|7", "3|8|F|extra", "4|9|G", "5|%N|%N", "", "6|1|%7C%25"]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    parse = lambda r: files.parse_delimited(r, FIELDS, checked=True)
    seen = []
    good = jobs.objects_to_table(raw, parse, ["k"], lambda df, location: seen.append(location),
                                 rules=[*quality.line_rules(FIELDS), *quality.not_null_rules(["k"])], columns=["k", "n", "s"])
    assert sorted(map(tuple, good.collect())) == [(4, 9, "G"), (5, None, None), (6, 1, "|%")]
    from pyspark.sql.types import StructType

    bad = jobs.quarantined(spark, good, StructType.fromDDL("line string, violations array<string>"))
    assert {r["line"]: r["violations"] for r in bad.collect()} == {
        "1|12x|O": ["bad_type:n"], "2|7": ["field_count:line"], "3|8|F|extra": ["field_count:line"],
        "": ["bad_type:k", "field_count:line", "not_null:k"]}
    with pytest.raises(AssertionError, match="key violations"):
        jobs.objects_to_table(raw.union(raw), parse, ["k"], lambda *a: None, rules=quality.line_rules(FIELDS), columns=["k", "n", "s"])
    all_bad = raw.filter("value = ''")
    assert jobs.objects_to_table(all_bad, parse, ["k"], lambda *a: None, rules=quality.line_rules(FIELDS), columns=["k"]).count() == 0


def _land(spark, base, wave, rows):
    files.write_text(spark.createDataFrame([(f"{k}|{t}",) for k, t in rows], "line string"), f"{base}/landing/wave={wave}")


def _run(spark, base):
    cols = [("k", "int"), ("ts", "timestamp_ntz")]
    once.load_once(spark, f"{base}/landing", lambda raw: files.parse_delimited(raw, cols), ["k"], "ts", "INTERVAL 1 HOUR",
                   f"{base}/table", f"{base}/_checkpoint", glob="*.txt")


def test_keys_are_loaded_once_and_replays_agree(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "s")
    _land(spark, base, 0, [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 09:00:00"), (2, "2024-01-01 12:00:00"), (3, "2024-01-01 11:30:00")])
    _run(spark, base)
    _land(spark, base, 1, [(3, "2024-01-01 12:30:00"), (4, "2024-01-01 10:59:00"), (5, "2024-01-01 13:00:00"), (6, "x")])
    real, state = DataFrameWriter.parquet, {"left": 1}

    def flaky(self, path, *a, **k):
        real(self, path, *a, **k)
        if "rows/batch_id=1" in path and state["left"]:
            state["left"] = 0
            raise RuntimeError("simulated crash")

    monkeypatch.setattr(DataFrameWriter, "parquet", flaky)
    with pytest.raises(Exception):
        _run(spark, base)
    _run(spark, base)
    _run(spark, base)  # nothing new
    table = f"{base}/table"
    assert sorted((r["k"], str(r["ts"])) for r in once.rows(spark, table).collect()) == [
        (1, "2024-01-01 09:00:00"), (2, "2024-01-01 12:00:00"), (3, "2024-01-01 11:30:00"), (5, "2024-01-01 13:00:00")]
    assert sorted((r["k"], r["ts"] is None) for r in once.rows(spark, table, once.LATE).collect()) == [(4, False), (6, True)]
    assert sorted((r["k"], r["n_rows"]) for r in once.rows(spark, table, once.REPEATED).collect()) == [(1, 1), (3, 1)]
    kept = spark.read.parquet(f"{table}/state/batch_id=1").filter("k IS NOT NULL")
    assert {r["k"] for r in kept.collect()} == {2, 5}  # 3 has expired


def test_sql_functions(spark):
    assert set(catalog.register(spark)) >= {"shop_item_total", "shop_days"}
    assert spark.sql("SELECT shop_signed_value('DEBITO', 3.5) AS v").first()["v"] == -3.5
    assert spark.sql("SELECT count(*) AS n FROM shop_days(DATE '2024-02-27', DATE '2024-03-01')").first()["n"] == 4
    assert spark.sql("SELECT count(*) AS n FROM shop_days(DATE '2024-03-02', DATE '2024-03-01')").first()["n"] == 0
    plan = spark.range(3).selectExpr("shop_item_total(cast(id as decimal(10,2)), 2.00) as t")._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_items_of_a_task_are_bounded(spark, tmp_dir, monkeypatch):
    from tillroll.plans import q_versions

    sf = _shop(spark, tmp_dir)
    few = q_versions.q_sql_functions(spark, sf)
    monkeypatch.setattr(q_versions, "ITEMS_A_TASK", 100)
    many = q_versions.q_sql_functions(spark, sf)
    assert sorted(few.collect()) == sorted(many.collect())
    plan = many._jdf.queryExecution().executedPlan().toString()
    # 1,200 orders and 3,600 items
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, 49\)", plan) and re.search(r"hashpartitioning\(o_orderkey#\d+L, 49\)", plan)
