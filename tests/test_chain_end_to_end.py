"""The whole chain on landed JSON files: derived bronze written as JSON lines
in two landings, every model run incrementally after each landing, compared
with one full run and with the direct (non-incremental) transforms."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.plans import models, silver
from ledgerline.sources import derived as D
from ledgerline.tables import load


def _write_json(df, path, mtime):
    df.select(F.to_json(F.struct(F.col("value"), F.col("data"))).alias("j")).write \
        .mode("overwrite").text(path)
    for root, _, files in os.walk(path):
        for f in files:
            os.utime(os.path.join(root, f), (mtime, mtime))


def _chain(spark, land_tx, land_blocks, out, run):
    ts = f"2025-01-05 0{run}:00:00"
    b = models.run_silver_blocks(spark, land_blocks, f"{out}/blocks", ts, f"r{run}")
    t = models.run_silver_transactions(spark, land_tx, f"{out}/txs", ts, f"r{run}")
    m = models.run_silver_msgs(spark, t, f"{out}/msgs", ts, f"r{run}")
    a = models.run_silver_msg_attributes(spark, m, f"{out}/attrs", ts, f"r{run}")
    lg = models.run_silver_transactions_logs(spark, t, f"{out}/logs", ts, f"r{run}")
    fm = models.run_fact(spark, "fact_msgs", m, f"{out}/fact_msgs", ts, f"r{run}")
    return b, t, m, a, lg, fm


def _keyset(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_incremental_chain_equals_full_and_direct(spark, tmp_dir):
    models.set_cluster_grain("year")      # 7 years of orders: few partitions
    try:
        _check_chain(spark, tmp_dir)
    finally:
        models.set_cluster_grain("day")


def _check_chain(spark, tmp_dir):
    orders, li = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
    btx = D.bronze_transactions(li)
    bbl = D.bronze_blocks(orders, li)
    cut = 500   # first landing: blocks below the cut, second: the rest
    now = time.time()
    land_tx, land_bl = f"{tmp_dir}/land/tx", f"{tmp_dir}/land/blocks"
    _write_json(btx.where(F.try_variant_get("value", "$.BLOCK_ID_REQUESTED", "bigint") < cut),
                f"{land_tx}/a", now - 7200)
    _write_json(bbl.where(F.try_variant_get("value", "$.BLOCK_ID", "bigint") < cut),
                f"{land_bl}/a", now - 7200)
    _chain(spark, land_tx, land_bl, f"{tmp_dir}/inc", 1)
    _write_json(btx.where(F.try_variant_get("value", "$.BLOCK_ID_REQUESTED", "bigint") >= cut),
                f"{land_tx}/b", now - 60)
    _write_json(bbl.where(F.try_variant_get("value", "$.BLOCK_ID", "bigint") >= cut),
                f"{land_bl}/b", now - 60)
    inc = _chain(spark, land_tx, land_bl, f"{tmp_dir}/inc", 2)
    full = _chain(spark, land_tx, land_bl, f"{tmp_dir}/full", 3)
    cols = [
        ["block_id", "chain_id", "tx_count", "proposer_address", "blocks_id"],
        ["block_id", "tx_id", "gas_used", "tx_succeeded", "transactions_id"],
        ["tx_id", "msg_index", "msg_group", "msg_sub_group", "msgs_id"],
        ["tx_id", "msg_index", "attribute_index", "attribute_key", "attribute_value"],
        ["tx_id", "transactions_logs_id"],
        ["tx_id", "msg_index", "msg_group", "fact_msgs_id"],
    ]
    for a, b, c in zip(inc, full, cols):
        assert _keyset(a, c) == _keyset(b, c)
    # and equal to the direct transforms over the same records
    direct = silver.silver_msgs(silver.silver_transactions(btx))
    assert _keyset(inc[2], cols[2]) == _keyset(direct, cols[2])
    assert inc[0].count() == silver.silver_blocks(bbl).count()


def test_run_chain_twice_is_stable(spark, tmp_dir):
    models.set_cluster_grain("year")
    try:
        orders, li = load(spark, SF_SMALL, "orders"), load(spark, SF_SMALL, "lineitem")
        land = f"{tmp_dir}/land"
        small = F.try_variant_get("value", "$.BLOCK_ID", "bigint") < 300
        _write_json(D.bronze_blocks(orders, li).where(small), f"{land}/blocks/a",
                    time.time() - 600)
        _write_json(D.bronze_transactions(li).where(
            F.try_variant_get("value", "$.BLOCK_ID_REQUESTED", "bigint") < 300),
            f"{land}/transactions/a", time.time() - 600)
        wh = f"{tmp_dir}/wh"
        prices = spark.createDataFrame([("cosmos", "1992-01-01 00:00:00", 2.0)], "id string, t string, close double").select(
            "id", F.to_timestamp_ntz("t").alias("recorded_hour"), "close")
        more = {"prices": prices, "status": D.bronze_status(orders)}
        first = models.run_chain(spark, land, wh, "2025-01-05 00:00:00", "r1",
                                 now="2025-01-05 00:00:00", **more)
        lists = first.pop("worklists")
        counts = {k: v.count() for k, v in first.items()}
        second = models.run_chain(spark, land, wh, "2025-01-05 01:00:00", "r2",
                                  now="2025-01-05 01:00:00", **more)
        assert second.pop("worklists") == lists and lists["blocks"] > 0 and lists["transactions"] == 0
        head = orders.agg(F.max("o_orderkey")).first()[0] + D.HEAD_AHEAD
        assert lists["blocks"] == head + 1 - second["complete_blocks"].count()
        assert lists["tx_counts"] == head + 1                     # no count was landed
        assert spark.read.json(f"{wh}/worklists/blocks").count() == lists["blocks"]
        fresh = {r.tbl: r.status for r in second["source_freshness"].collect()}
        assert set(fresh) == {"blocks", "transactions"} and set(fresh.values()) == {"pass"}
        assert {k: v.count() for k, v in second.items() if k not in (
            "blocks_completeness", "transactions_completeness")} == {
            k: v for k, v in counts.items() if k not in (
                "blocks_completeness", "transactions_completeness")}
        assert counts["ez_core_metrics_hourly"] == counts["core_metrics_hourly"] > 0 == counts["silver_hourly_prices"] - 1
        assert second["blocks_completeness"].count() == 2      # one audit row per run
        assert {r.status for r in second["silver_checks"].collect()} <= {"pass", "error"}
        assert second["silver_checks"].where("check_name = 'unique'").agg(
            F.sum("failures")).first()[0] == 0
    finally:
        models.set_cluster_grain("day")
