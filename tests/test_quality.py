"""A13, A17-A21 on the shop fixture and on driver-table shapes."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quality, reconcile
from tillroll.schemas import VARCHAR_LIMITS

from shop_fixture import frames


@pytest.fixture(scope="module")
def shop(spark):
    return frames(spark)


def test_primary_key_duplicates_and_nulls(spark, shop):
    bad = quality.check_primary_key(shop["cliente"], ["id"]).collect()
    assert [(r.id, r.n) for r in bad] == [(2, 2)]
    df = spark.createDataFrame([(1,), (None,), (3,)], "id int")
    bad = quality.check_primary_key(df, ["id"]).collect()
    assert [(r.id, r.n) for r in bad] == [(None, 1)]


def test_unique_ignores_nulls(spark, shop):
    bad = quality.check_unique(shop["cliente"], ["email"]).collect()
    assert [(r.email, r.n) for r in bad] == [("ana@example.org", 2)]
    df = spark.createDataFrame([(None,), (None,), ("a",), ("A",)], "e string")
    assert quality.check_unique(df, ["e"]).count() == 0  # NULLs never collide, case-sensitive


def test_not_null_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rep = {r.column_name: r.violations
           for r in quality.row_rule_report(df, "t", quality.not_null_rules(["a", "b"])).collect()}
    assert rep == {"a": 1, "b": 2}


def test_not_null_on_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    rep = quality.row_rule_report(df, "t", quality.not_null_rules(["a"])).collect()
    assert rep[0].violations == 0


def test_foreign_keys(shop):
    orphans = quality.check_foreign_key(shop["pedido_itens"], shop["produto"], ["id_produto"], ["id"])
    assert [r.id for r in orphans.collect()] == [103]
    # NULL category passes
    assert quality.check_foreign_key(shop["produto"], shop["categorias_produto"],
                                     ["id_categoria"], ["id"]).count() == 0
    assert quality.check_foreign_key(shop["pedido_itens"], shop["pedido_cabecalho"],
                                     ["id_pedido"], ["id"]).count() == 0


def test_domain_rules(spark, shop):
    rules = [quality.max_length_rule("telefone", VARCHAR_LIMITS[("cliente", "telefone")])]
    off = quality.offending_rows(shop["cliente"], rules, ["id"]).collect()
    assert [(r.id, r.rule) for r in off] == [(4, "max_length_20")]
    # characters, not bytes
    df = spark.createDataFrame([("Açúcar",)], "s string")
    assert quality.offending_rows(df, [quality.max_length_rule("s", 6)], ["s"]).count() == 0
    money = spark.createDataFrame([(D("99999999.99"),), (D("100000000.00"),), (None,)], "v decimal(12,2)")
    r = quality.offending_rows(money, [quality.decimal_fits_rule("v", "v")], ["v"]).collect()
    assert [x.v for x in r] == [D("100000000.00")]
    r = quality.offending_rows(money, [quality.money_range_rule("v")], ["v"]).collect()
    assert [x.v for x in r] == [D("100000000.00")]


def test_split_valid(spark, shop):
    rules = quality.not_null_rules(["telefone"]) + [quality.max_length_rule("telefone", 20)]
    valid, bad = quality.split_valid(shop["cliente"], rules)
    assert valid.count() == 1
    got = sorted((r.id, tuple(r.violations)) for r in bad.collect())
    assert got == [(2, ("not_null:telefone",)), (2, ("not_null:telefone",)), (4, ("max_length_20:telefone",))]


def test_key_report(shop):
    r = quality.key_report(shop["cliente"], "cliente", ["id"]).first()
    assert (r.rule, r.violations) == ("primary_key", 2)


def test_missing_objects(spark):
    expected = spark.createDataFrame([("a.txt",), ("b.txt",)], "name string")
    listing = spark.createDataFrame([("a.txt", 3)], "name string, length long")
    assert [r.name for r in quality.missing_objects(expected, listing).collect()] == ["b.txt"]
    with pytest.raises(AssertionError):
        quality.assert_empty(quality.missing_objects(expected, listing), "missing")


def test_order_reconcile_on_shop(shop):
    items = shop["pedido_itens"]
    out = reconcile.reconcile_orders(shop["pedido_cabecalho"], items, "id", "valor_total", "id_pedido",
                                     F.col("quantidade") * F.col("preco_unitario"))
    got = {r.id: (r.declared, r.computed, r.difference, r.status) for r in out.collect()}
    assert got == {
        10: (D("48.30"), D("48.30"), D("0.00"), "ok"),
        11: (D("42.10"), D("42.00"), D("0.10"), "mismatch"),
        12: (D("19.90"), D("0.00"), D("19.90"), "no_items"),
    }
