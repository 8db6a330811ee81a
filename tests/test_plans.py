"""Plan-shape regressions: the properties the scale design relies on."""

import re

from conftest import SF_SMALL
from ledgerline.catalog import QUERIES


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    # distinct shuffle exchanges (a reused exchange is not a second shuffle)
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


def test_message_chain_shuffles_once_and_reads_shredded_fields(spark):
    plan = _plan(spark, "silver_msgs")
    assert _shuffles(plan) == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "data:variant" not in scan and "ReadSchema: struct<" in scan


def test_dedupe_limits_before_the_shuffle(spark):
    plan = _plan(spark, "latest_by_key")
    lines = plan.splitlines()
    partial = next(i for i, s in enumerate(lines) if "WindowGroupLimit" in s and "Partial" in s)
    exchange = next(i for i, s in enumerate(lines) if "Exchange hashpartitioning" in s)
    assert partial > exchange          # printed below = runs before the exchange


def test_hourly_metrics_without_expand(spark):
    assert "Expand" not in _plan(spark, "hourly_metrics")


def test_logs_two_shuffles(spark):
    assert _shuffles(_plan(spark, "normalize_logs")) == 2


def test_scans_prune_columns(spark):
    plan = _plan(spark, "count_mismatch")
    schemas = re.findall(r"ReadSchema: (struct<[^ ]*>)", plan)
    assert schemas and all(s.count(":") == 1 for s in schemas)   # one column per side


def test_runner_path_shuffles_transactions_not_exploded_rows(spark, tmp_dir):
    from ledgerline.catalog import _silver_txs
    from ledgerline.plans import silver
    path = f"{tmp_dir}/silver_txs"
    _silver_txs(spark, SF_SMALL).write.parquet(path)
    stored = spark.read.parquet(path)
    for df, want in ((silver.silver_msgs(stored, partition_input=True), 1),
                     (silver.normalize_logs(stored, partition_input=True), 2)):
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert _shuffles(plan) == want
