"""B12 incremental: exactly-once loading across runs and after a crash."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tillroll.operators import quality
from tillroll.sinks import files
from tillroll.streaming.ingest import loaded, quarantined, run_ingestion


def _parse(raw):
    parts = F.split(F.col("value"), r"\|")
    return raw.select(parts[0].try_cast("bigint").alias("id"), parts[1].alias("name"))


def _rules():
    return quality.not_null_rules(["id"])


def _land(spark, landing, wave, ids):
    rows = spark.createDataFrame([(f"{i}|n{i}" if i % 10 else f"|bad{i}",) for i in ids], "line string")
    files.write_text(rows, os.path.join(landing, f"wave={wave}"))


def _paths(tmp_dir):
    return [os.path.join(tmp_dir, p) for p in ("landing", "table", "_checkpoint")]


def test_waves_load_once(spark, tmp_dir):
    landing, target, ckpt = _paths(tmp_dir)
    _land(spark, landing, 0, range(1, 51))
    run_ingestion(spark, landing, _parse, _rules(), target, ckpt, glob="*.txt")
    _land(spark, landing, 1, range(51, 101))
    run_ingestion(spark, landing, _parse, _rules(), target, ckpt, glob="*.txt")
    run_ingestion(spark, landing, _parse, _rules(), target, ckpt, glob="*.txt")  # nothing new
    good = loaded(spark, target)
    assert good.count() == 90 and good.select("id").distinct().count() == 90
    bad = quarantined(spark, target)
    assert bad.count() == 10
    assert bad.filter(F.array_contains("violations", "not_null:id")).count() == 10


def test_crash_mid_batch_is_replayed_without_duplicates(spark, tmp_dir, monkeypatch):
    landing, target, ckpt = _paths(tmp_dir)
    _land(spark, landing, 0, range(1, 101))
    real = DataFrameWriter.parquet
    state = {"crashed": False}

    def flaky(self, path, *a, **k):
        # the batch is written, then the job dies before it is committed
        real(self, path, *a, **k)
        if not state["crashed"]:
            state["crashed"] = True
            raise RuntimeError("simulated crash")

    monkeypatch.setattr(DataFrameWriter, "parquet", flaky)
    with pytest.raises(Exception):
        run_ingestion(spark, landing, _parse, _rules(), target, ckpt, glob="*.txt")
    assert state["crashed"]
    assert loaded(spark, target).count() == 90  # output of the failed batch
    run_ingestion(spark, landing, _parse, _rules(), target, ckpt, glob="*.txt")
    good = loaded(spark, target)
    assert good.count() == 90 and good.select("id").distinct().count() == 90
    assert quarantined(spark, target).count() == 10
