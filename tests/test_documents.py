"""B1-B9 over nested documents."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import timefmt
from tillroll.operators import nested, reconcile, transform
from tillroll.sources.documents import read_json

import doc_fixtures as fx


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("docs"))
    paths = {n: fx.write(d, f"{n}.json", v) for n, v in
             [("extrato", fx.STATEMENTS), ("pedido", fx.ORDER), ("produtos", fx.PRODUCTS), ("tags", fx.TAGS)]}
    return {
        "extrato": read_json(spark, paths["extrato"], schemas.STATEMENTS),
        "pedido": read_json(spark, paths["pedido"], schemas.ORDER_DOC),
        "produtos": read_json(spark, paths["produtos"], schemas.PRODUCT_ENVELOPE),
        "tags": read_json(spark, paths["tags"], schemas.TAG_LISTS),
        "paths": paths,
    }


def test_multiline_roots(docs):
    assert docs["extrato"].count() == 4   # array root: one row per element
    assert docs["pedido"].count() == 1    # object root: one row
    assert docs["produtos"].count() == 1
    assert docs["tags"].count() == 7


def test_single_line_reader_fails_on_pretty_file(spark, docs):
    with pytest.raises(Exception):
        read_json(spark, docs["paths"]["pedido"], schemas.ORDER_DOC, multi_line=False).collect()


def test_explode_statements(docs):
    tx = nested.explode_rows(docs["extrato"], "transacoes", ["id_extrato"])
    assert tx.count() == 7
    by_type = {r.tipo: (r.n, r.total) for r in
               tx.groupBy("tipo").agg(F.count("*").alias("n"), F.sum("valor").alias("total")).collect()}
    assert by_type == {"DEBITO": (4, D("-628.15")), "CREDITO": (3, D("605.00"))}
    totals = reconcile.totals_by_type(tx, ["id_extrato"], "tipo", "valor")
    assert totals.count() == 5


def test_statement_balances(docs):
    rows = reconcile.statement_balances(docs["extrato"]).collect()
    assert all(r.balanced for r in rows)
    assert sorted(r.closing for r in rows) == [D("-75.40"), D("90.00"), D("262.35"), D("1000.00")]


def test_period_containment(docs):
    tx = nested.explode_rows(docs["extrato"], "transacoes", ["id_extrato"]).join(
        docs["extrato"].select("id_extrato", "periodo"), "id_extrato")
    tx = tx.select(timefmt.parse_iso("data").alias("t"),
                   timefmt.parse_iso("periodo.data_inicio").alias("a"),
                   timefmt.parse_iso("periodo.data_fim").alias("b"))
    assert transform.within_period(tx, "t", "a", "b").count() == 7  # both bounds inclusive


def test_order_document_total(docs):
    o = docs["pedido"]
    assert o.select(F.size("itens")).first()[0] == 5
    ok = o.select(reconcile.reconcile_document_total(
        F.col("itens"), "quantidade", "preco_unitario", F.col("entrega.taxa_frete"), F.col("total_pedido"))
    ).first()[0]
    assert ok is True


def test_document_reconciliation(spark):
    item = "array<struct<q: int, p: decimal(10,2)>>"
    rows = [
        (1, D("7.50"), D("2.50"), [(2, D("1.00")), (1, D("3.00"))]),
        (2, D("9.00"), None, [(1, D("4.00"))]), (2, D("9.00"), None, [(1, D("5.00"))]),  # one order, two documents
        (3, D("3.00"), D("1.00"), [(1, D("1.00")), (None, D("8.00")), (4, None)]),
        (4, D("5.00"), D("5.00"), None), (5, None, None, []),
    ]
    df = spark.createDataFrame(rows, f"id int, total decimal(10,2), extra decimal(10,2), items {item}")
    got = {r.id: tuple(r)[1:] for r in
           reconcile.reconcile_documents(df, "id", "items", "q", "p", "total", "extra").collect()}
    assert got == {
        1: (D("7.50"), D("7.50"), D("0.00"), "ok"), 2: (D("9.00"), D("9.00"), D("0.00"), "ok"),
        3: (D("3.00"), D("2.00"), D("1.00"), "mismatch"), 4: (D("5.00"), D("5.00"), D("0.00"), "no_items"),
        5: (None, D("0.00"), None, "no_items"),
    }


def test_flatten_order(docs):
    flat = nested.flatten(docs["pedido"])
    assert "entrega_endereco_cidade" in flat.columns and "itens" in flat.columns
    r = flat.first()
    assert r.entrega_endereco_cidade == "Belém" and r.entrega_endereco_complemento is None


def test_envelope_unwrap_and_presence(docs):
    rows = nested.unwrap(docs["produtos"], "produtos", ["api_version"])
    assert rows.count() == 5
    assert {r.api_version for r in rows.collect()} == {"7"}
    pres = {r.field: r.present for r in nested.presence_report(
        rows, ["tags", "variacoes", "detalhes", "preco_anterior", "avaliacoes", "especificacoes.ram"]).collect()}
    assert pres == {"tags": 1, "variacoes": 2, "detalhes": 2, "preco_anterior": 2, "avaliacoes": 0,
                    "especificacoes.ram": 1}
    var = nested.explode_rows(rows, "variacoes", ["id"])
    assert var.count() == 3 and var.filter(F.col("estoque") == 0).count() == 2


def test_tags_inner_outer(docs):
    t = docs["tags"]
    inner = nested.explode_scalars(t, "tags", ["produto_id"], "tag")
    outer = nested.explode_scalars(t, "tags", ["produto_id"], "tag", outer=True)
    assert inner.count() == 6 and outer.count() == 10
    counts = {r.tag: r.n for r in nested.value_counts(inner, "tag").collect()}
    assert counts == {"noite": 2, "trilha": 3, "chuva": 1}
    sizes = {r.produto_id: r.s for r in t.select("produto_id", F.size("tags").alias("s")).collect()}
    assert sizes == {31: None, 32: 3, 33: 1, 34: 0, 35: None, 36: 2, 37: 0}


def test_nest_explode_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    docs = nested.nest(df, ["k"], "items", ["v"], max_items=10, spread=[])
    assert docs.count() == 3  # NULL key is its own document
    back = nested.explode_rows(docs, "items", ["k"])
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_nest_with_staged_heavy_keys(spark, tmp_path):
    n = F.col("id")
    spark.range(400).select(F.when(n >= 300, F.lit(7)).when(n >= 20, n).alias("k"), n.alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))  # one key of 101 rows and one of NULL
    plain = nested.nest(df, ["k"], "items", ["v"], max_items=10)
    staged = nested.nest(df, ["k"], "items", ["v"], max_items=10, stage_heavy=True)
    assert sorted(staged.collect(), key=str) == sorted(plain.collect(), key=str)
    # the rows meet the heavy keys where they are, and are shuffled once
    plan = staged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_posexplode_position(spark):
    df = spark.createDataFrame([(1, ["x", "y"])], "k int, a array<string>")
    out = nested.explode_rows(df, "a", ["k"], position="pos").collect()
    assert [(r.pos, r.a) for r in out] == [(0, "x"), (1, "y")]


def test_malformed_document_kept_for_quarantine(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from tillroll.sources.documents import CORRUPT, read_json

    (tmp_path / "a.json").write_text('[{"k": 1, "v": "x"}, {"k": 2, "v": "y"}]')
    (tmp_path / "b.json").write_text('[{"k": 3, "v": "z"')  # truncated
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    with pytest.raises(Exception):
        read_json(spark, str(tmp_path), schema).collect()
    rows = read_json(spark, str(tmp_path), schema, keep_malformed=True).collect()
    good = sorted(r.k for r in rows if r[CORRUPT] is None)
    bad = [r for r in rows if r[CORRUPT] is not None]
    assert good == [1, 2] and len(bad) == 1 and bad[0].k is None


def test_flatten_refuses_one_name_for_two_fields(spark):
    import pytest

    df = spark.sql("SELECT named_struct('b_c', 1) AS a, named_struct('c', 2) AS a_b")
    with pytest.raises(ValueError, match="one name"):
        nested.flatten(df)
    assert nested.flatten(df, sep=".").columns == ["a.b_c", "a_b.c"]
