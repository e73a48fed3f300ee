"""a small product table (A1-A9) with answers worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tillroll.operators import profile, transform
from tillroll.schemas import PRODUCTS_FLAT
from tillroll.sources.inline import inline_rows

# A garden shop's eight products.
ROWS = [
    ("Enxada", "Jardim", 34.25, 12),
    ("Alface", "Horta", 2.75, 640),
    ("Pomada", "Saúde", 18.5, 45),
    ("Regador", "Jardim", 27.0, 30),
    ("Rúcula", "Horta", 3.25, 410),
    ("Vaso", "Jardim", 11.75, 75),
    ("Gaze", "Saúde", 6.5, 225),
    ("Tesoura", "Jardim", 41.0, 9),
]


@pytest.fixture(scope="module")
def products(spark):
    return inline_rows(spark, ROWS, PRODUCTS_FLAT)


def test_inline_types_and_text(products):
    assert [f.dataType.simpleString() for f in products.schema.fields] == ["string", "string", "double", "bigint"]
    assert products.filter(F.col("Produto") == "Rúcula").count() == 1


def test_inline_rejects_bad_width(spark):
    with pytest.raises(ValueError):
        inline_rows(spark, [("a", "b", 1.0)], PRODUCTS_FLAT)


def test_filter_eq_exact(products):
    assert transform.filter_eq(products, "Categoria", "Saúde").count() == 2
    assert transform.filter_eq(products, "Categoria", "saúde").count() == 0
    assert transform.filter_eq(products, "Categoria", "Saude").count() == 0


def test_filter_eq_null_refused(products):
    with pytest.raises(ValueError):
        transform.filter_eq(products, "Categoria", None)


def test_add_product(products, spark):
    out = transform.add_product(products, "Valor_Total_Estoque", "Preco", "Estoque")
    assert out.columns[-1] == "Valor_Total_Estoque"
    assert out.schema["Valor_Total_Estoque"].dataType.simpleString() == "double"
    got = [round(r[0], 6) for r in out.select("Valor_Total_Estoque").collect()]
    assert got == [411.0, 1760.0, 832.5, 810.0, 1332.5, 881.25, 1462.5, 369.0]
    nulls = spark.createDataFrame([(None, 2)], "a double, b long")
    assert transform.add_product(nulls, "c", "a", "b").first()["c"] is None


def test_group_mean(products):
    got = {r["Categoria"]: round(r["Preco_Medio"], 6)
           for r in profile.group_mean(products, "Categoria", "Preco", "Preco_Medio").collect()}
    assert got == {"Jardim": 28.5, "Horta": 3.0, "Saúde": 12.5}


def test_group_mean_null_and_nan(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", float("nan")), (None, 5.0), ("b", None), ("b", 3.0)], "k string, v double"
    )
    spark_form = {r["k"]: r["m"] for r in profile.group_mean(df, "k", "v", "m").collect()}
    assert None in spark_form and spark_form[None] == 5.0
    assert math.isnan(spark_form["a"])
    assert spark_form["b"] == 3.0
    pandas_form = {r["k"]: r["m"] for r in
                   profile.group_mean(df, "k", "v", "m", drop_null_keys=True, skip_nan=True).collect()}
    assert pandas_form == {"a": 1.0, "b": 3.0}


def _describe(df, **kw):
    return {(r["column_name"], r["stat"]): r["value"] for r in profile.describe_numeric(df, **kw).collect()}


def test_describe_exact(products):
    d = _describe(products)
    expect = {
        ("Preco", "count"): 8, ("Preco", "mean"): 18.125, ("Preco", "std"): 14.617138,
        ("Preco", "min"): 2.75, ("Preco", "25%"): 5.6875, ("Preco", "50%"): 15.125,
        ("Preco", "75%"): 28.8125, ("Preco", "max"): 41.0,
        ("Estoque", "count"): 8, ("Estoque", "mean"): 180.75, ("Estoque", "std"): 231.681894,
        ("Estoque", "min"): 9.0, ("Estoque", "25%"): 25.5, ("Estoque", "50%"): 60.0,
        ("Estoque", "75%"): 271.25, ("Estoque", "max"): 640.0,
    }
    assert set(d) == set(expect)
    for k, v in expect.items():
        assert d[k] == pytest.approx(v, abs=1e-6), k


def test_describe_approx_runs(products):
    d = _describe(products, approx=True)
    assert d[("Preco", "50%")] in {11.75, 18.5}  # a sketch returns an observed value


def test_describe_rejects_text(products):
    with pytest.raises(ValueError):
        profile.describe_numeric(products, ["Produto"])


def test_schema_report(products, spark):
    rows = profile.schema_report(products).orderBy("position").collect()
    assert [(r.column_name, r.data_type, r.non_null, r.row_count) for r in rows] == [
        ("Produto", "string", 8, 8), ("Categoria", "string", 8, 8),
        ("Preco", "double", 8, 8), ("Estoque", "bigint", 8, 8),
    ]
    with_null = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    r = {x.column_name: x.non_null for x in profile.schema_report(with_null).collect()}
    assert r == {"a": 2, "b": 1}


def test_preview_ordered(products):
    rows = transform.preview(products, "Preco", 3).collect()
    assert [r.Preco for r in rows] == [2.75, 3.25, 6.5]
    with pytest.raises(ValueError):
        transform.preview(products, [], 3)


def test_project_and_rename(products, spark):
    dup = products.unionAll(products)
    assert transform.project(dup, ["Produto"]).count() == 16
    out = transform.rename(products, {"Preco": "price"})
    assert "price" in out.columns and "Preco" not in out.columns
    with pytest.raises(ValueError):
        transform.rename(products, {"nope": "x"})
