"""Batch update with automatic modification stamp."""

from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.operators.update import update_rows

from shop_fixture import T0, frames

NOW = datetime(2025, 10, 1, 12, 0)


@pytest.fixture(scope="module")
def products(spark):
    return frames(spark)["produto"]


def _apply(spark, products, rows, schema):
    upd = spark.createDataFrame(rows, schema)
    out = update_rows(products, upd, "id", "data_atualizacao", F.lit(NOW).cast("timestamp"))
    return {r.id: r for r in out.collect()}


def test_change_price_stamps_only_matched(spark, products):
    out = _apply(spark, products, [(1, D("21.00"))], "id int, preco decimal(10,2)")
    assert out[1].preco == D("21.00") and out[1].data_atualizacao == NOW
    assert out[2].data_atualizacao == T0 and out[2].preco == D("8.50")
    assert out[1].data_criacao == T0  # creation time untouched
    assert len(out) == 4


def test_identical_values_still_stamped(spark, products):
    out = _apply(spark, products, [(2, D("8.50"))], "id int, preco decimal(10,2)")
    assert out[2].preco == D("8.50") and out[2].data_atualizacao == NOW


def test_update_to_null(spark, products):
    out = _apply(spark, products, [(3, None)], "id int, descricao string")
    assert out[3].descricao is None and out[3].data_atualizacao == NOW


def test_unknown_id_inserts_nothing(spark, products):
    out = _apply(spark, products, [(999, D("1.00"))], "id int, preco decimal(10,2)")
    assert 999 not in out and all(r.data_atualizacao == T0 for r in out.values())


def test_caller_stamp_overwritten(spark, products):
    out = _apply(spark, products, [(1, D("1.00"), datetime(2000, 1, 1))],
                 "id int, preco decimal(10,2), data_atualizacao timestamp")
    assert out[1].data_atualizacao == NOW


def test_duplicate_keys_fail(spark, products):
    upd = spark.createDataFrame([(1, D("1.00")), (1, D("2.00"))], "id int, preco decimal(10,2)")
    out = update_rows(products, upd, "id", "data_atualizacao", F.lit(NOW).cast("timestamp"))
    with pytest.raises(PySparkException, match="duplicate key"):
        out.collect()


@pytest.mark.parametrize("action", [
    lambda out: out.count(),
    lambda out: out.select("id").collect(),
    lambda out: out.select("nome").collect(),
])
def test_duplicate_keys_fail_whatever_is_read(spark, products, action):
    for key in (1, 999):  # with and without a target row
        upd = spark.createDataFrame([(key, D("1.00")), (key, D("1.00"))], "id int, preco decimal(10,2)")
        out = update_rows(products, upd, "id", "data_atualizacao", F.lit(NOW).cast("timestamp"))
        with pytest.raises(PySparkException, match="duplicate key"):
            action(out)


def test_empty_batch_is_identity(spark, products):
    upd = spark.createDataFrame([], "id int, preco decimal(10,2)")
    out = update_rows(products, upd, "id", "data_atualizacao", F.lit(NOW).cast("timestamp"))
    assert sorted(out.collect()) == sorted(products.collect())


def test_unknown_column_refused(spark, products):
    upd = spark.createDataFrame([(1, 5)], "id int, nope int")
    with pytest.raises(ValueError):
        update_rows(products, upd, "id", "data_atualizacao", F.current_timestamp())
