"""Incremental runs over landed files: k batches == one full refresh (modulo
audit columns), re-runs are idempotent, audits append and restart."""

import json
import os
import time

import pytest

from pyspark.sql import functions as F

from ledgerline.plans import models
from ledgerline.sources.versions import read_table


def _block(h, prop="P", ts="2025-01-02T10:00:00Z"):
    return {"value": {"BLOCK_ID": h}, "data": {"result": {"block": {"header": {
        "height": str(h), "time": ts, "chain_id": "c", "proposer_address": prop},
        "data": {"txs": ["x"] * (h % 3)}}}}}


def _land(root, name, recs, mtime):
    p = os.path.join(root, name)
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")
    os.utime(p, (mtime, mtime))


def _cols(df):
    return sorted((r.block_id, r.proposer_address, r.tx_count) for r in
                  df.select("block_id", "proposer_address", "tx_count").collect())


def test_incremental_equals_full(spark, tmp_dir, monkeypatch):
    from ledgerline.sources import sinks
    merges = []
    real = sinks.upsert_table
    monkeypatch.setattr(models, "upsert_table",
                        lambda *a, **k: (merges.append(1), real(*a, **k))[1])
    land = os.path.join(tmp_dir, "blocks")
    os.makedirs(land)
    t0 = time.time() - 10_000
    _land(land, "1_a.json", [_block(h) for h in range(1, 6)], t0)
    inc = os.path.join(tmp_dir, "inc")
    models.run_silver_blocks(spark, land, inc, "2025-01-03 00:00:00", "r1")
    _land(land, "1_b.json", [_block(h, "Q") for h in (4, 5, 6, 8)], t0 + 100)
    models.run_silver_blocks(spark, land, inc, "2025-01-03 01:00:00", "r2")
    models.run_silver_blocks(spark, land, inc, "2025-01-03 02:00:00", "r3")   # no-op re-run
    full = os.path.join(tmp_dir, "full")
    models.run_silver_blocks(spark, land, full, "2025-01-03 03:00:00", "f")
    assert len(merges) == 2                 # runs 2 and 3 merged, run 1 created
    from ledgerline.sources.sinks import load_watermarks
    assert load_watermarks(spark, inc)["_inserted_timestamp"] is not None
    a, b = read_table(spark, inc), read_table(spark, full)
    assert _cols(a) == _cols(b)
    # inclusive high-water mark: run 2 re-reads the boundary file (1_a), run 3
    # reads only the newest file (1_b), so 1_a-only blocks keep run 2's audit
    inv = {r.block_id: r._invocation_id for r in a.collect()}
    assert inv[1] == "r2" and inv[8] == "r3"
    assert a.groupBy("blocks_id").count().where("count > 1").count() == 0
    got = dict((r.block_id, r.proposer_address) for r in a.collect())
    assert got[4] == "Q" and got[1] == "P" and 7 not in got


def test_audit_appends_and_restarts(spark, tmp_dir):
    blocks = spark.createDataFrame(
        [(h, f"2025-01-01 {h % 24:02d}:00:00") for h in (1, 2, 3, 5, 6, 9)],
        "block_id bigint, t string").select("block_id",
                                            F.to_timestamp_ntz("t").alias("block_timestamp"))
    path = os.path.join(tmp_dir, "audit")
    r1 = models.run_blocks_audit(spark, blocks, path, "2025-01-03 00:00:00",
                                 now="2025-01-03 00:00:00").collect()
    assert r1[0].blocks_impacted_array == [4, 7, 8]
    r2 = models.run_blocks_audit(spark, blocks, path, "2025-01-03 01:00:00",
                                 now="2025-01-03 01:00:00")
    last = r2.orderBy(F.col("test_timestamp").desc()).first()
    assert r2.count() == 2 and last.min_block == 3 and last.blocks_impacted_array == [4, 7, 8]


def test_prices_merge_keeps_first_insert(spark, tmp_dir):
    p = spark.createDataFrame([("cosmos", "2025-01-02 01:00:00", 1.0),
                               ("cosmos", "2025-01-02 02:00:00", 2.0),
                               ("other", "2025-01-02 01:00:00", 9.0)],
                              "id string, t string, close double").select(
        "id", F.to_timestamp_ntz("t").alias("recorded_hour"), "close")
    path = os.path.join(tmp_dir, "prices")
    models.run_silver_prices(spark, p, "cosmos", path, "2025-01-03 00:00:00")
    p2 = p.withColumn("close", F.col("close") + 10)
    out = models.run_silver_prices(spark, p2, "cosmos", path, "2025-01-04 00:00:00").collect()
    assert sorted((r.close, str(r.inserted_timestamp), str(r.modified_timestamp)) for r in out) == [
        (11.0, "2025-01-03 00:00:00", "2025-01-04 00:00:00"),
        (12.0, "2025-01-03 00:00:00", "2025-01-04 00:00:00")]


def test_bronze_view_explodes_pages(spark, tmp_dir):
    from ledgerline.plans.bronze import bronze
    root = os.path.join(tmp_dir, "root")
    os.makedirs(os.path.join(root, "transactions"))
    page = {"value": {"BLOCK_ID_REQUESTED": 5, "PAGE_NUMBER": 1},
            "data": {"result": {"txs": [{"hash": "a"}, {"hash": "b"}], "total_count": "2"}}}
    _land(os.path.join(root, "transactions"), "5_x.json", [page], time.time())
    df = bronze(spark, root, "transactions", incremental=False, explode_key="result.txs")
    from ledgerline.functions import vget
    assert sorted(r.h for r in df.select(vget("data", "hash").alias("h")).collect()) == ["a", "b"]


def test_block_ledger_keeps_first_insert(spark, tmp_dir):
    land = os.path.join(tmp_dir, "blocks")
    os.makedirs(land)
    t0 = time.time() - 10_000
    _land(land, "1_a.json", [_block(h) for h in (1, 2)], t0)
    path = os.path.join(tmp_dir, "ledger")
    models.run_blocks_complete(spark, land, path, "2025-01-03 00:00:00")
    _land(land, "1_b.json", [_block(h) for h in (2, 3)], t0 + 100)
    out = models.run_blocks_complete(spark, land, path, "2025-01-04 00:00:00")
    got = {r.block_id: (str(r.inserted_timestamp), str(r.modified_timestamp))
           for r in out.collect()}
    assert got == {1: ("2025-01-03 00:00:00", "2025-01-04 00:00:00"),
                   2: ("2025-01-03 00:00:00", "2025-01-04 00:00:00"),
                   3: ("2025-01-04 00:00:00", "2025-01-04 00:00:00")}


def _facts(spark, rows):
    return spark.createDataFrame(rows, "block_id bigint, tx_id string, ok boolean, gas bigint, "
                                       "ts string, mod string").select(
        "block_id", "tx_id", F.col("ok").alias("tx_succeeded"), F.col("gas").alias("gas_used"),
        F.to_timestamp_ntz("ts").alias("block_timestamp"),
        F.to_timestamp_ntz("mod").alias("modified_timestamp"))


def test_metrics_replace_changed_hours_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "m")
    f1 = _facts(spark, [(1, "a", True, 10, "2025-01-02 00:10:00", "2025-01-02 05:00:00"),
                        (2, "b", False, 5, "2025-01-02 01:10:00", "2025-01-02 05:00:00"),
                        (3, "c", True, 7, "2025-01-02 02:10:00", "2025-01-02 05:00:00")])
    models.run_core_metrics_hourly(spark, f1, path, "2025-01-02 06:00:00", "r1",
                                   now="2025-01-02 06:00:00")
    # a late tx lands in hour 01; hour 00 is untouched and keeps its first run id
    f2 = f1.unionByName(_facts(spark, [(4, "d", True, 1, "2025-01-02 01:20:00",
                                        "2025-01-02 07:00:00")]))
    out = models.run_core_metrics_hourly(spark, f2, path, "2025-01-02 07:30:00", "r2",
                                         now="2025-01-02 07:30:00")
    got = {str(r.block_timestamp_hour)[11:13]: (r.transaction_count, r.total_gas_used,
                                                r._invocation_id) for r in out.collect()}
    assert got == {"00": (1, 10, "r1"), "01": (2, 6, "r2"), "02": (1, 7, "r2")}
    # nothing changed since: no run, table unchanged
    same = models.run_core_metrics_hourly(spark, f2, path, "2025-01-02 09:00:00", "r3",
                                          now="2025-01-02 09:00:00")
    assert {r._invocation_id for r in same.collect()} == {"r1", "r2"}


def test_priced_metrics_lookback(spark, tmp_dir):
    mpath, epath = os.path.join(tmp_dir, "m"), os.path.join(tmp_dir, "ez")
    f = _facts(spark, [(h, f"t{h}", True, 10, f"2025-01-02 {h:02d}:10:00",
                        "2025-01-02 12:00:00") for h in range(10)])
    prices = spark.createDataFrame([("cosmos", "2025-01-02 00:00:00", 2.0)],
                                   "id string, t string, close double").select(
        "id", F.to_timestamp_ntz("t").alias("recorded_hour"), "close")
    m = models.run_core_metrics_hourly(spark, f, mpath, "2025-01-02 12:30:00", "r1",
                                       now="2025-01-02 12:30:00")
    ez = models.run_ez_metrics(spark, m, prices, "cosmos", epath, "2025-01-02 12:45:00",
                               now="2025-01-02 12:45:00")
    assert ez.count() == 10 and {r.total_fees_usd for r in ez.collect()} == {20.0}
    last = ez.agg(F.max("modified_timestamp")).first()[0]
    f2 = f.unionByName(_facts(spark, [(99, "late", True, 5, "2025-01-02 08:30:00",
                                       "2025-01-02 13:00:00")]))
    m2 = models.run_core_metrics_hourly(spark, f2, mpath, "2025-01-02 13:30:00", "r2",
                                        now="2025-01-02 13:30:00")
    ez2 = models.run_ez_metrics(spark, m2, prices, "cosmos", epath, "2025-01-02 13:45:00",
                                now="2025-01-02 13:45:00")
    # recompute from 4 h before the earliest stats hour modified at/after the
    # mark; the mark is inclusive and inherited, so the previous stats batch
    # (all ten hours, one modification time) is taken again: 00 → 20 the day before
    from ledgerline.operators import min_changed_period
    start = min_changed_period(m2, "block_timestamp_hour", "modified_timestamp", last,
                               lookback_hours=4)
    assert str(start) == "2025-01-01 20:00:00"
    # ez rows inherit the stats rows' modification time
    mod = {str(r.block_timestamp_hour)[11:13]: str(r.modified_timestamp)[11:16]
           for r in ez2.collect()}
    assert mod["08"] == "13:30" and mod["03"] == "12:30"
    row8 = [r for r in ez2.collect() if str(r.block_timestamp_hour)[11:13] == "08"][0]
    assert row8.total_fees_native == 15 and row8.total_fees_usd == 30.0


def test_planning_run_publishes_worklists(spark, tmp_dir):
    land = os.path.join(tmp_dir, "blocks")
    os.makedirs(land)
    _land(land, "1_a.json", [_block(h) for h in (0, 1, 2, 4)], time.time() - 100)
    ledger = models.run_blocks_complete(spark, land, os.path.join(tmp_dir, "ledger"),
                                        "2025-01-03 00:00:00")
    status = spark.createDataFrame([('{"result":{"sync_info":{"latest_block_height":"6"}}}',)],
                                   "j string").select(F.parse_json("j").alias("data"))
    tx_done = spark.createDataFrame([(0,), (1,)], "block_id bigint")
    pages_done = spark.createDataFrame([(1, 1)], "block_id bigint, page_number bigint")
    counts = models.run_worklists(spark, status, ledger, tx_done, pages_done,
                                  os.path.join(tmp_dir, "wl"), batch_size=2)
    # blocks 3, 5, 6 missing; tx counts for 2..6; pages: blocks 2 and 4 (1 has its page)
    assert counts == {"blocks": 3, "tx_counts": 5, "transactions": 2}


def test_late_file_in_an_old_folder_is_loaded(spark, tmp_dir):
    land, path = os.path.join(tmp_dir, "blocks"), os.path.join(tmp_dir, "silver")
    for d in ("2024-12-01", "2025-01-02"):
        os.makedirs(os.path.join(land, d))
    _land(os.path.join(land, "2025-01-02"), "1_b.json", [_block(3)], time.time() - 3600)
    models.run_silver_blocks(spark, land, path, "2025-01-03 00:00:00", "r1")
    _land(os.path.join(land, "2024-12-01"), "1_a.json", [_block(1)], time.time() - 60)
    out = models.run_silver_blocks(spark, land, path, "2025-01-04 00:00:00", "r2")
    assert sorted(r.block_id for r in out.collect()) == [1, 3]


def test_block_that_changes_its_date_stays_unique(spark, tmp_dir):
    land, path = os.path.join(tmp_dir, "blocks"), os.path.join(tmp_dir, "silver")
    os.makedirs(land)
    timeless = _block(7)
    for v in timeless["data"].values():
        v["block"]["header"].pop("time", None)
    _land(land, "1_a.json", [timeless, _block(8)], time.time() - 3600)
    first = models.run_silver_blocks(spark, land, path, "2025-01-03 00:00:00", "r1")
    assert {r.block_id: r.block_timestamp is None for r in first.collect()} == {7: True, 8: False}
    _land(land, "1_b.json", [_block(7)], time.time() - 60)
    out = models.run_silver_blocks(spark, land, path, "2025-01-04 00:00:00", "r2").collect()
    assert {r.block_id: r.block_timestamp is None for r in out} == {7: False, 8: False} and len(out) == 2


def test_duplicate_batch_keys_are_refused(spark, tmp_dir):
    from ledgerline.sources.sinks import upsert_table
    b = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], "k int, v string, p int")
    with pytest.raises(ValueError, match="duplicate"):
        upsert_table(spark, os.path.join(tmp_dir, "t"), b, ["k"], "p")


def test_audit_rerun_leaves_one_row(spark, tmp_dir):
    blocks = spark.createDataFrame([(i, f"2025-01-01 00:00:0{i}") for i in (1, 2, 5)],
                                   "block_id long, t string").selectExpr(
        "block_id", "cast(t as timestamp_ntz) as block_timestamp")
    path = os.path.join(tmp_dir, "audit")
    for ts in ("2025-01-03 00:00:00", "2025-01-03 00:00:00", "2025-01-04 00:00:00", "2025-01-04 00:00:00"):
        out = models.run_blocks_audit(spark, blocks, path, ts, "2025-01-04 12:00:00", full=True)
    assert sorted(str(r.test_timestamp) for r in out.collect()) == ["2025-01-03 00:00:00", "2025-01-04 00:00:00"]


def silver_blocks_of(bronze):
    from ledgerline.plans import silver
    return silver.silver_blocks(bronze).collect()


def test_page_and_count_ledgers(spark, tmp_dir):
    land_tx = os.path.join(tmp_dir, "tx")
    land_tc = os.path.join(tmp_dir, "tc")
    os.makedirs(land_tx)
    os.makedirs(land_tc)
    pages = [{"value": {"BLOCK_ID_REQUESTED": b, "PAGE_NUMBER": p}, "data": {"hash": f"h{b}{p}"}}
             for b, p in ((5, 1), (5, 2), (6, 1))] + [
            {"value": {"BLOCK_ID_REQUESTED": 7, "PAGE_NUMBER": 1}, "data": []}]
    _land(land_tx, "5_a.json", pages, time.time() - 100)
    counts = [{"value": {"block_id": 5}, "data": {"result": {"total_count": "150"}}},
              {"value": {"BLOCK_ID": 6}, "data": {"result": {"total_count": "1"}}}]
    _land(land_tc, "5_a.json", counts, time.time() - 100)
    led = models.run_transactions_complete(spark, land_tx, os.path.join(tmp_dir, "p"),
                                           "2025-01-03 00:00:00")
    assert sorted((r.block_id, r.page_number) for r in led.collect()) == [(5, 1), (5, 2), (6, 1)]
    tc = models.run_tx_count_complete(spark, land_tc, os.path.join(tmp_dir, "c"),
                                      "2025-01-03 00:00:00")
    assert sorted((r.block_id, r.tx_count) for r in tc.collect()) == [(5, 150), (6, 1)]
    # a second run a day later: keys stay unique, the first insert time is kept
    _land(land_tx, "5_b.json", pages[:2] + [{"value": {"BLOCK_ID_REQUESTED": 9, "PAGE_NUMBER": 1},
                                            "data": {"hash": "h9"}}], time.time() - 10)
    _land(land_tc, "5_b.json", counts[:1], time.time() - 10)
    led = models.run_transactions_complete(spark, land_tx, os.path.join(tmp_dir, "p"),
                                           "2025-01-04 00:00:00").collect()
    assert sorted((r.block_id, r.page_number, str(r.inserted_timestamp)[:10]) for r in led) == [
        (5, 1, "2025-01-03"), (5, 2, "2025-01-03"), (6, 1, "2025-01-03"), (9, 1, "2025-01-04")]
    tc = models.run_tx_count_complete(spark, land_tc, os.path.join(tmp_dir, "c"),
                                      "2025-01-04 00:00:00").collect()
    assert sorted((r.block_id, str(r.inserted_timestamp)[:10]) for r in tc) == [
        (5, "2025-01-03"), (6, "2025-01-03")]
