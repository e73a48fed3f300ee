"""Skew and exactness properties that matter at scale.

* a key holding a third of all rows never becomes one array: ``nest``
  splits it into bounded documents and the round trip loses nothing;
* exact quartiles equal a brute-force computation on random data;
* group-wise checks pre-aggregate (partial aggregate before the exchange).
"""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillroll.operators import nested, profile

SF = "/root/testdata/sf0.01"


def test_hot_key_is_split(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # derived hot key: every line with line number <= 3 belongs to order 0
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 3, F.lit(0)).otherwise(F.col("l_orderkey")))
    share = hot.filter("l_orderkey = 0").count() / hot.count()
    assert share > 0.3
    docs = nested.nest(hot, ["l_orderkey"], "itens", ["l_linenumber", "l_partkey", "l_quantity"], max_items=500)
    sizes = docs.select("l_orderkey", F.size("itens").alias("n"))
    biggest = sizes.agg(F.max("n")).first()[0]
    assert biggest <= 2 * 500  # hash chunks stay close to the bound
    assert sizes.filter("l_orderkey = 0").count() >= share * hot.count() / 500
    back = nested.explode_rows(docs, "itens", ["l_orderkey"])
    assert back.count() == hot.count()
    assert back.agg(F.sum("l_partkey")).first()[0] == hot.agg(F.sum("l_partkey")).first()[0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
                min_size=1, max_size=60))
def test_exact_quartiles_match_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["stat"]: r["value"] for r in profile.describe_numeric(df, ["x"]).collect()}
    s = pd.Series(values)
    for q, name in [(0.25, "25%"), (0.5, "50%"), (0.75, "75%")]:
        assert got[name] == pytest.approx(float(np.quantile(s, q)), rel=1e-9, abs=1e-9)
    assert got["min"] == min(values) and got["max"] == max(values)


def test_quartiles_with_hot_value(spark):
    # one value holds most rows: it collapses to one weighted row
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4000, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))
    got = {r["stat"]: r["value"] for r in profile.describe_numeric(df).collect()}
    ref = df.toPandas()["x"]
    for q, name in [(0.25, "25%"), (0.5, "50%"), (0.75, "75%")]:
        assert got[name] == pytest.approx(float(np.quantile(ref, q)))


def test_many_partitions_quartiles(spark):
    df = spark.range(0, 20000, numPartitions=16).select((F.col("id") * 0.5).alias("x"))
    got = {r["stat"]: r["value"] for r in profile.describe_numeric(df).collect()}
    ref = np.arange(0, 20000) * 0.5
    for q, name in [(0.25, "25%"), (0.5, "50%"), (0.75, "75%")]:
        assert got[name] == pytest.approx(float(np.quantile(ref, q)))


def _brute(values, levels=(0.25, 0.5, 0.75)):
    s = np.sort(np.asarray(values, dtype=float))
    return {q: float(np.quantile(s, q)) if not np.isnan(s).any() else None for q in levels}


@pytest.mark.parametrize("case", ["spread", "hot", "negative"])
def test_bracket_rounds_stay_exact(spark, case):
    # a tiny window and a coarse sketch force several narrowing rounds
    rng = np.random.default_rng(7)
    if case == "spread":
        vals = rng.lognormal(3, 2, 30000)
    elif case == "hot":
        vals = np.where(rng.random(30000) < 0.4, 42.0, rng.normal(40, 5, 30000))
    else:
        vals = np.round(rng.normal(-100, 30, 30000), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": vals})).repartition(7)
    got = {r["level"]: r["value"] for r in
           profile._exact_quantiles(df, ["x"], (0.25, 0.5, 0.75), accuracy=50, max_window=300).collect()}
    for q, ref in _brute(vals).items():
        assert got[q] == pytest.approx(ref, rel=1e-12, abs=1e-12)


def test_quantiles_with_nan_and_null(spark):
    vals = [1.0, 2.0, None, float("nan"), 3.0, 4.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["level"]: r["value"] for r in
           profile._exact_quantiles(df, ["x"], (0.25, 0.5, 0.75)).collect()}
    # 6 non-null values, NaN sorts last: [1, 2, 3, 4, NaN, NaN]
    assert got[0.25] == pytest.approx(2.25)
    assert got[0.5] == pytest.approx(3.5)
    assert np.isnan(got[0.75])


def test_identical_rows_spread_by_file_position(spark, tmp_path):
    # one key, 6000 identical rows: the content hash alone cannot split them
    path = str(tmp_path / "same")
    spark.range(6000, numPartitions=3).select(F.lit(1).alias("k"), F.lit("x").alias("v")) \
        .write.parquet(path)
    src = spark.read.parquet(path)
    docs = nested.nest(src, ["k"], "items", ["v"], max_items=500)
    sizes = [r[0] for r in docs.select(F.size("items")).collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 2 * 500 and len(sizes) >= 6
    assert docs.columns == ["k", "chunk", "items"]


def test_rows_without_a_position_need_spread(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    with pytest.raises(ValueError, match="spread"):
        nested.nest(df, ["k"], "items", ["v"], max_items=10)
    docs = nested.nest(df, ["k"], "items", ["v"], max_items=10, spread=[])
    assert docs.agg(F.sum(F.size("items"))).first()[0] == 100 and docs.count() > 1


def test_foreign_key_check_keeps_repeated_rows(spark):
    from tillroll.operators import quality

    child = spark.createDataFrame([(1, "a"), (9, "b"), (9, "b"), (None, "c")], "fk long, v string")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    got = quality.check_foreign_key(child, parent, ["fk"], ["id"]).collect()
    assert [tuple(r) for r in got] == [(9, "b"), (9, "b")]


def test_hot_value_leaves_few_rows_to_the_window(spark):
    # 60 % of the rows share a value at a quartile's edge; a coarse sketch and a small bound
    n = 40_000
    df = spark.range(n, numPartitions=4).select(
        F.when(F.col("id") < 0.6 * n, F.lit(0.0)).otherwise(F.col("id").cast("double")).alias("x"))
    levels = (0.25, 0.5, (0.6 * n - 0.5) / (n - 1), 0.75)
    out = profile._exact_quantiles(df, ["x"], levels, accuracy=100, max_window=100)
    got = {r["level"]: r["value"] for r in out.collect()}
    ref = np.sort(df.toPandas()["x"])
    for q in levels:
        assert got[q] == pytest.approx(float(np.quantile(ref, q)))


def test_quartiles_with_infinite_values(spark):
    vals = [float("-inf")] * 900 + [float(i) for i in range(1500)] + [float("inf")] * 600
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["level"]: r["value"] for r in
           profile._exact_quantiles(df, ["x"], (0.4, 0.5, 0.7), max_window=50).collect()}
    for q in (0.4, 0.5, 0.7):
        assert got[q] == pytest.approx(float(np.quantile(vals, q)))


@pytest.mark.parametrize("case", ["spread", "hot", "small", "nan", "empty"])
def test_quartiles_take_two_passes_before_the_last(spark, monkeypatch, case):
    rng = np.random.default_rng(11)
    vals = {"spread": rng.lognormal(3, 2, 60_000), "hot": np.where(rng.random(60_000) < 0.4, 42.0, rng.normal(40, 5, 60_000)),
            "small": rng.normal(0, 1, 500), "nan": np.where(rng.random(60_000) < 0.1, np.nan, rng.normal(0, 1, 60_000)),
            "empty": np.zeros(0)}[case]
    df = spark.createDataFrame(pd.DataFrame({"x": vals}), "x double").repartition(5)
    df = df.select(F.coalesce("x", F.lit(float("nan"))).alias("x"))  # pandas sends NaN as NULL
    passes = []
    kind, agg = type(df), type(df).agg
    monkeypatch.setattr(kind, "agg", lambda self, *a: (passes.append(a), agg(self, *a))[1])
    out = profile.describe_numeric(df, ["x"])
    # NaN shifts the ranks the first sketch was asked for: one more round
    assert len(passes) == {"spread": 2, "hot": 2, "small": 1, "nan": 4, "empty": 1}[case]
    monkeypatch.undo()
    got = {r["stat"]: r["value"] for r in out.collect()}
    ref = np.sort(vals)
    for q, name in [(0.25, "25%"), (0.5, "50%"), (0.75, "75%")]:
        if case == "empty":
            assert got[name] is None
        else:  # NaN sorts last
            h = (len(ref) - 1) * q
            a, b = ref[int(np.floor(h))], ref[int(np.ceil(h))]
            assert got[name] == pytest.approx(a + (h - np.floor(h)) * (b - a), rel=1e-12)


@pytest.mark.parametrize("approx", [False, True])
def test_describe_reports_a_column_without_values(spark, approx):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None)], "x double, y double")
    got = {(r["column_name"], r["stat"]): r["value"]
           for r in profile.describe_numeric(df, approx=approx, skip_nan=True).collect()}
    assert len(got) == 16 and got["x", "count"] == 1 and got["x", "max"] == 1 and got["y", "count"] == 0
    assert all(got["y", s] is None for s in profile.DESCRIBE_STATS[1:])
