"""Physical-plan properties: pushdown, pruning, join strategy, no Python."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


def _final(df):
    # run this DataFrame's own plan (only a row count reaches the driver) so
    # that adaptive execution has settled it
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def _plan(spark, name):
    return _final(entry.queries()[name](spark, SF))


def test_filter_pushed_to_scan(spark):
    p = _plan(spark, "q_filter_eq")
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,ECONOMY)]" in p


def test_group_mean_reads_two_columns(spark):
    p = _plan(spark, "q_group_mean")
    assert "ReadSchema: struct<p_type:string,p_retailprice:double>" in p
    assert "partial_avg" in p


def test_fixed_dimensions_broadcast(spark):
    p = _plan(spark, "q_lookup_join")
    assert "BroadcastHashJoin" in p


def test_reconcile_pre_aggregates_items(spark):
    p = _plan(spark, "q_order_reconcile")
    assert "partial_sum" in p


def test_backup_partition_pruned(spark):
    p = _plan(spark, "q_backup_partition")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in p


@pytest.mark.parametrize("name", sorted(q for q in entry.queries() if q.startswith("q_")))
def test_no_python_in_plans(spark, name):
    p = _plan(spark, name)
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas",
                   "MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsIn"):
        assert marker not in p, f"{name} runs Python: {marker}"


@pytest.mark.parametrize("name", ["q_explode_items", "q_nest_sizes", "q_nest_hot_key", "q_flatten",
                                  "q_fk_orphans", "q_update_stamp", "q_lookup_join"])
def test_building_reads_no_rows(spark, name):
    # one plan at every size: building runs at most the jobs that read file footers
    group = f"build-{name}"
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        entry.queries()[name](spark, SF)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup(group)) <= len(TABLES_READ[name])


TABLES_READ = {
    "q_explode_items": ["lineitem"], "q_nest_sizes": ["lineitem"], "q_nest_hot_key": ["lineitem"],
    "q_flatten": ["customer", "nation", "region"], "q_fk_orphans": ["orders", "customer"],
    "q_update_stamp": ["orders"], "q_lookup_join": ["customer", "nation", "region", "orders"],
}


@pytest.mark.parametrize("name", ["q_describe", "q_describe_items"])
def test_quartiles_never_range_partition_the_column(spark, name):
    p = _plan(spark, name)
    assert "rangepartitioning" not in p.lower()
    assert "partial_count" in p  # bracket values collapse to (value, weight) per task


def test_fk_check_is_one_anti_join(spark):
    p = _plan(spark, "q_fk_orphans")
    assert "LeftAnti" in p and "LeftSemi" not in p
