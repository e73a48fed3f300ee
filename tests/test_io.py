"""Objects, catalog tables, backups, JDBC options."""

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.plans import jobs
from tillroll.sinks import files, jdbc as jdbc_sink, tables
from tillroll.sources import jdbc as jdbc_source, objects


def _tree(root):
    layout = {"a.txt": "hello\n", "sub/b.txt": "two\nlines\n", "sub/deeper/c.txt": "x" * 40}
    for rel, text in layout.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)
    os.makedirs(os.path.join(root, "empty"), exist_ok=True)
    return {k: len(v.encode()) for k, v in layout.items()}


def test_listing_names_and_sizes(spark, tmp_dir):
    sizes = _tree(tmp_dir)
    got = {r.name: r.length for r in objects.list_objects(spark, tmp_dir).collect()}
    assert got == sizes


def test_inventory_has_the_columns_of_a_listing(spark, tmp_dir):
    inv = spark.createDataFrame([("shop/a+b.txt", 3, "2024-01-01T00:00:00Z"), ("shop/d/100%.txt", 0, "2024-01-02T00:00:00Z"),
                                 ("other/c.txt", 9, None)], "Key string, Size int, LastModifiedDate string")
    got = objects.from_inventory(inv, "Key", "Size", "LastModifiedDate", prefix="shop/")
    assert got.columns == objects.list_objects(spark, tmp_dir).columns
    assert {(r["name"], r["length"]) for r in got.collect()} == {("a+b.txt", 3), ("d/100%.txt", 0)}
    expected = spark.createDataFrame([("a+b.txt",), ("gone.txt",)], "name string")
    assert [r.name for r in quality.missing_objects(expected, got).collect()] == ["gone.txt"]


def test_listing_empty_dir(spark, tmp_dir):
    _tree(tmp_dir)
    assert objects.list_objects(spark, os.path.join(tmp_dir, "empty")).count() == 0


def test_manifest_missing(spark, tmp_dir):
    sizes = _tree(tmp_dir)
    expected = spark.createDataFrame([(n,) for n in list(sizes) + ["sub/missing.txt"]], "name string")
    missing = quality.missing_objects(expected, objects.list_objects(spark, tmp_dir))
    assert [r.name for r in missing.collect()] == ["sub/missing.txt"]


def test_text_write_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "k int, v string")
    path = os.path.join(tmp_dir, "out")
    files.write_text(df.select(files.delimited_line(["k", "v"]).alias("line")), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1|a b", "2|%N"]
    files.write_text(df.select(files.delimited_line(["k"]).alias("line")), path)  # same name: replaced
    assert spark.read.text(path).count() == 2


def test_odd_text_round_trips(spark, tmp_dir):
    rows = [(1, "a|b", None), (2, "c\nd\r", ""), (3, "%0A%N%7C", "%"), (None, "", "%N"), (5, None, "\\")]
    df = spark.createDataFrame(rows, "k int, v string, w string")
    path = os.path.join(tmp_dir, "odd")
    files.write_text(df.select(files.delimited_line(["k", "v", "w"]).alias("line")), path)
    back = files.parse_delimited(spark.read.text(path), [("k", "int"), ("v", "string"), ("w", "string")])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_reload_idempotent(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    t = "tillroll_test_reload"
    tables.reload(df, t)
    tables.reload(df, t)
    assert spark.table(t).count() == 100
    tables.reload(spark.table(t).filter("id < 10"), t)  # reading the table while replacing it
    assert spark.table(t).count() == 10


def test_reload_refuses_another_definition(spark):
    t = "tillroll_test_reload_columns"
    tables.reload(spark.range(3).withColumn("a", F.lit(1)), t)
    with pytest.raises(ValueError, match="another definition"):
        tables.reload(spark.range(3).withColumn("a", F.lit(1)).withColumn("c", F.lit(2)), t)
    with pytest.raises(ValueError, match="another definition"):
        tables.reload(spark.range(3).withColumn("a", F.lit(1)), t, fmt="orc")
    assert spark.table(t).count() == 3


def test_append_by_name_with_defaults(spark):
    t = "tillroll_test_append"
    tables.reload(spark.createDataFrame([], "id int, nome string, estoque int, ativo boolean"), t)
    defaults = {"estoque": F.lit(0), "ativo": F.lit(False)}
    tables.append_by_name(spark.createDataFrame([("x", 1, None)], "nome string, id int, estoque int"), t, defaults)
    tables.append_by_name(spark.createDataFrame([(2, "y")], "id int, nome string"), t, defaults)
    got = sorted(tuple(r) for r in spark.table(t).collect())
    assert got == [(1, "x", None, False), (2, "y", 0, False)]  # explicit NULL stays NULL
    with pytest.raises(ValueError):
        tables.append_by_name(spark.createDataFrame([(3,)], "id int"), t)  # no default for nome
    with pytest.raises(ValueError):
        tables.append_by_name(spark.createDataFrame([(3, "z", 1)], "id int, nome string, extra int"), t, defaults)


def test_backup_and_verify(spark, tmp_dir):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    path = os.path.join(tmp_dir, "backup")
    jobs.table_to_backup(orders, path, ["o_orderstatus"])
    back = spark.read.schema(orders.schema).parquet(path).select(*orders.columns)
    assert files.same_content(orders, back)
    assert not files.same_content(orders, back.filter("o_orderstatus <> 'F'"))
    plan = back.filter(F.col("o_orderstatus") == "F")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan


def test_json_documents_written_and_read(spark, tmp_dir):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    from tillroll.sources.documents import read_json
    docs = spark.range(25).select(F.col("id").alias("k"), F.lit("x").alias("v"),
                                  (F.col("id") % 3).alias("file_id"))
    path = os.path.join(tmp_dir, "docs")
    files.write_json_documents(docs, path, "file_id")
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    back = read_json(spark, path, schema, multi_line=True)
    assert sorted(r.k for r in back.collect()) == list(range(25))
    assert not any(os.path.isdir(os.path.join(path, n)) for n in os.listdir(path))
    assert len([n for n in os.listdir(path) if n.endswith(".txt")]) == 3  # a file each


def test_json_lines_written_and_read(spark, tmp_dir):
    from tillroll.sources.documents import read_json
    rows = [(1, "a\nb"), (2, None), (None, ""), (2, None)]
    docs = spark.createDataFrame(rows, "k long, v string").coalesce(1)
    path = os.path.join(tmp_dir, "lines")
    files.write_json_lines(docs, path, max_records_per_file=3)
    assert len([n for n in os.listdir(path) if n.endswith(".json")]) == 2
    back = read_json(spark, path, docs.schema, multi_line=False)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_objects_to_table_rejects_duplicate_keys(spark):
    raw = spark.createDataFrame([("1|a",), ("1|b",)], "value string")
    parse = lambda df: df.select(F.split("value", r"\|")[0].cast("int").alias("id"))
    with pytest.raises(AssertionError):
        jobs.objects_to_table(raw, parse, ["id"], jobs.load_catalog_table("tillroll_test_never"))


def test_jdbc_options():
    conn = {"url": "jdbc:postgresql://db.example:5432/shop", "user": "u", "password": "p"}
    o = jdbc_source.jdbc_options(conn, table="produto",
                                 partition=jdbc_source.Partitioning("id", 1, 1000, 8))
    assert o["dbtable"] == "produto" and o["numPartitions"] == "8" and o["partitionColumn"] == "id"
    q = jdbc_source.jdbc_options(conn, query="select 1", partition=jdbc_source.Partitioning("id", 1, 2, 2))
    assert q["dbtable"].startswith("(select 1)") and "query" not in q
    with pytest.raises(ValueError):
        jdbc_source.jdbc_options({"user": "u"}, table="t")
    with pytest.raises(ValueError):
        jdbc_source.jdbc_options(conn, table="t", query="select 1")
    sql = jdbc_sink.swap_sql("produto", "produto_stage", ["id", "nome"])
    assert 'INSERT INTO produto ("id", "nome") SELECT "id", "nome" FROM produto_stage' in sql
    assert sql[0] == "BEGIN" and sql[-1] == "COMMIT"


def test_scale_settings():
    from tillroll.session import scale_settings

    big = scale_settings(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_settings(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_observed_fingerprint_equals_separate_pass(spark, tmp_dir):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    observed, obs = files.observed_fingerprint(orders)
    files.backup(observed, os.path.join(tmp_dir, "copy"), ["o_orderstatus"])
    direct = files.fingerprint(orders).first()
    assert (obs.get["rows"], obs.get["hash_sum"]) == (direct["rows"], direct["hash_sum"])


def test_shared_folder_required_on_a_cluster(spark):
    from tillroll import session

    class FakeContext:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class FakeSession:
        sparkContext = FakeContext()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_shared_dir(FakeSession())


def test_listing_keeps_odd_names(spark, tmp_dir):
    names = {"a+b.txt", "e%41.txt", "100%.txt", "with space.txt"}
    for n in names:
        with open(os.path.join(tmp_dir, n), "w") as f:
            f.write("x")
    assert {r["name"] for r in objects.list_objects(spark, tmp_dir).collect()} == names


def test_fingerprint_sees_where_nulls_are(spark):
    a = spark.createDataFrame([("x", None)], "p string, q string")
    b = spark.createDataFrame([(None, "x")], "p string, q string")
    assert files.fingerprint(a).first() != files.fingerprint(b).first()


def test_inventory_matches_listing(spark, tmp_dir):
    _tree(tmp_dir)
    listed = objects.list_objects(spark, tmp_dir)
    inv = listed.select(F.concat(F.lit("shop/"), "name").alias("key"), "length", "modificationTime")
    back = objects.from_inventory(inv, "key", "length", "modificationTime", prefix="shop/")
    assert sorted(r["name"] for r in back.collect()) == sorted(r["name"] for r in listed.collect())
