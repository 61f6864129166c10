"""What the executed plans must and must not contain."""

import pytest

import __spark_entry__ as contract
from compare import database, differences
from skew import write_skewed
from jobtide.plans.binding import Tables
from jobtide.operators import sizing

FOLDER = "/root/testdata/sf0.001"
EAGER = {"delimited_months", "incremental_month", "schooling_year_pair"}
LAZY = sorted(set(contract.queries()) - EAGER)


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_flag_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(contract.entry(spark))
    assert "PushedFilters: [In(l_returnflag, [A,R])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    assert "partial_sum" in plan


def test_dimensions_are_broadcast_only_below_the_threshold(spark):
    tables = Tables(spark, FOLDER)
    small = sizing.broadcast_if_small(tables.customer, tables.customer)
    assert "Hint broadcast" in small._jdf.queryExecution().logical().toString()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        large = sizing.broadcast_if_small(tables.customer, tables.customer)
        assert "Hint broadcast" not in large._jdf.queryExecution().logical().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_shuffles_grow_with_the_input(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fact = Tables(spark, FOLDER).lineitem
    sizing.size_shuffles(fact)
    assert spark.conf.get(key, None) is None
    monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 1024)
    try:
        sizing.size_shuffles(fact)
        assert int(spark.conf.get(key)) == sizing.file_bytes(fact) // 1024
        assert differences(spark, FOLDER, "monthly_balance", database(FOLDER)) == []
    finally:
        spark.conf.unset(key)


def test_the_users_own_shuffle_setting_comes_back(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fact = Tables(spark, FOLDER).lineitem
    size = sizing.BYTES_PER_PARTITION
    try:
        spark.conf.set(key, "30")
        sizing.size_shuffles(fact)
        assert spark.conf.get(key) == "30"
        monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 1024)
        sizing.size_shuffles(fact)
        sizing.size_shuffles(fact)
        assert int(spark.conf.get(key)) > 30
        monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", size)
        sizing.size_shuffles(fact)
        assert spark.conf.get(key) == "30"
    finally:
        spark.conf.unset(key)
    sizing.size_shuffles(fact)
    assert spark.conf.get(key, None) is None


def test_shuffles_grow_with_known_rows(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fact = Tables(spark, FOLDER).lineitem
    try:
        # Repetitive rows fill few bytes, but as much memory as others.
        sizing.size_shuffles(fact, 1000 * sizing.ROWS_PER_PARTITION)
        assert spark.conf.get(key) == "1000"
        sizing.size_shuffles(fact, sizing.ROWS_PER_PARTITION)
        assert spark.conf.get(key, None) is None
    finally:
        spark.conf.unset(key)


def test_small_sides_are_hashed_where_asked_for(spark, large_table_joins):
    tables = Tables(spark, FOLDER)

    def joined():
        keys = tables.customer.withColumnRenamed("c_custkey", "o_custkey")
        result = tables.orders.repartition("o_orderkey").join(keys, "o_custkey", "left")
        return len(result.collect()), plan_of(result)

    before = spark.conf.get(sizing.HASH_JOIN_BYTES)
    with sizing.hash_joins(spark):
        rows, plan = joined()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan[: plan.index("Initial Plan")]
    assert spark.conf.get(sizing.HASH_JOIN_BYTES) == before
    same, plan = joined()
    assert same == rows and "SortMergeJoin" in plan[: plan.index("Initial Plan")]


def test_missing_files_scan_the_fact_once(spark):
    plan = plan_of(contract.queries()["missing_files"](spark, FOLDER))
    assert plan.count("l_returnflag:string") == 1 and "LeftAnti" not in plan


@pytest.fixture
def large_table_joins(spark):
    """Every table counts as too large to broadcast, every partition as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.01",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    return write_skewed(spark, FOLDER, tmp_path_factory.mktemp("skewed"))


@pytest.mark.parametrize(
    "name",
    [
        "monthly_balance",
        "balance_by_sector",
        "balance_by_phase",
        "municipality_years",
        "enriched_rows",
        "decoded_rows",
        "missing_months",
        "missing_files",
        "null_profile",
        "reject_report",
    ],
)
def test_results_hold_on_skewed_tables_with_sort_merge_joins(spark, skewed, large_table_joins, name):
    assert differences(spark, skewed, name, database(skewed)) == []


def test_hot_keys_are_split(spark, skewed, large_table_joins):
    result = contract.queries()["balance_by_sector"](spark, str(skewed))
    result.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(result)


@pytest.mark.parametrize(
    "name",
    [
        "first_years_zoom",
        "sector_three_years",
        "sector_growth",
        "uf_ranking",
        "month_year_matrix",
        "top_municipalities",
        "bottom_municipalities",
        "sector_evolution",
        "schooling_year_pair",
    ],
)
def test_years_reach_the_scan(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


@pytest.mark.parametrize("name", ["balance_by_sector", "balance_by_phase", "sector_growth", "base_cube_rollups", "domains"])
def test_movements_are_added_up_before_the_part_join(spark, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    below = plan[plan.index("[l_partkey") :]
    assert "HashAggregate(keys=[ano_mes" in below and "l_partkey" in below[below.index("HashAggregate(keys=[ano_mes") :]
