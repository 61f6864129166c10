"""Month-by-month arrival gives the sums of one batch."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from jobtide.operators.aggregate import balance_by
from jobtide.operators.enrich import add_balance, add_period
from jobtide.plans.catalog import conform_stored
from jobtide.session import shared_folder
from jobtide.streaming.monthly import current_monthly, refresh_monthly


def prepare(arrivals):
    return add_balance(add_period(arrivals)).where(F.col("tipo_mov").isin(1, -1))


def test_refresh_equals_batch(spark, tmp_path):
    source, state, out = (str(tmp_path / name) for name in ("mov", "pos", "saldo"))
    arrivals = [
        [("202001", 1.0), ("202001", 1.0), ("202002", -1.0)],
        [("202003", 1.0), ("202003", 0.0)],
        [("202001", -1.0), ("202013", 1.0)],
    ]
    expected_2020_01 = [2, 2, 1]
    for arrived, january in zip(arrivals, expected_2020_01):
        rows = conform_stored(spark.createDataFrame(arrived, "ano_mes string, tipo_mov double"))
        rows.coalesce(1).write.mode("append").parquet(source)
        refresh_monthly(spark, source, state, out, prepare)
        now = {row.mes: row.saldo for row in current_monthly(spark, out).collect()}
        assert now[1] == january
    batch = balance_by(prepare(spark.read.parquet(source)), "ano", "mes", "ano_mes")
    assert sorted(map(tuple, batch.collect())) == sorted(
        tuple(row) for row in current_monthly(spark, out).select(batch.columns).collect()
    )
    files = set(spark.read.parquet(out).inputFiles())
    refresh_monthly(spark, source, state, out, prepare)
    assert set(spark.read.parquet(out).inputFiles()) == files


def test_batches_run_with_adaptive_execution(spark, tmp_path):
    source, state, out = (str(tmp_path / name) for name in ("mov", "pos", "saldo"))
    rows = spark.createDataFrame([("202001", 1.0)], "ano_mes string, tipo_mov double")
    conform_stored(rows).write.parquet(source)
    plans = []

    def spy(batch):
        plans.append(batch.groupBy("ano_mes").count()._jdf.queryExecution().executedPlan().toString())
        return prepare(batch)

    refresh_monthly(spark, source, state, out, spy)
    assert len(plans) == 1 and "AdaptiveSparkPlan" in plans[0]


def test_shared_folder_is_below_the_checkpoint_folder(spark):
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    given = session(**{"spark.checkpoint.dir": "hdfs://x/y/", "spark.master": "yarn"})
    assert shared_folder(given, "a").startswith("hdfs://x/y/a-")
    with pytest.raises(ValueError):
        shared_folder(session(**{"spark.master": "yarn"}), "a")
    assert shared_folder(spark, "a") != shared_folder(spark, "a")
