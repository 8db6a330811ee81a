"""Small operators without a registered query of their own."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import (closed_hours, count_by_key, drop_empty, drop_errors,
                                  join_file_meta, project, restrict_to_batch, settled)
from ledgerline.operators.incremental import changed_since


def test_record_filters(spark):
    df = spark.createDataFrame([(1, '{"x":1}', '{}'), (2, '{"error":null}', '{}'),
                                (3, '[]', '{}'), (4, '{"y":2}', '{"data":{"error":"t"}}'),
                                (5, None, '{}')], "id int, d string, v string").select(
        "id", F.parse_json("d").alias("data"), F.parse_json("v").alias("value"))
    assert sorted(r.id for r in drop_errors(df).collect()) == [1, 3, 5]
    assert sorted(r.id for r in drop_empty(df).collect()) == [1, 2, 4]


def test_time_filters_and_counts(spark):
    df = spark.createDataFrame([("2025-01-02 09:59:59", "a"), ("2025-01-02 10:00:00", "a"),
                                ("2025-01-01 21:00:00", "b")], "t string, k string").select(
        F.to_timestamp_ntz("t").alias("ts"), "k")
    assert closed_hours(df, "ts", "2025-01-02 10:30:00").count() == 2
    assert settled(df, "ts", "2025-01-02 10:00:00", hours=12).count() == 1
    assert sorted(tuple(r) for r in count_by_key(df, "k").collect()) == [("a", 2), ("b", 1)]


def test_file_meta_projection_and_batch_bound(spark):
    recs = spark.createDataFrame([("f1", 1, 10), ("f2", 2, 20)], "file_name string, "
                                 "partition_key int, block_id int")
    meta = spark.createDataFrame([("f1", 1, "2025-01-01")], "file_name string, "
                                 "partition_key int, registered string")
    j = join_file_meta(recs, meta).collect()
    assert [(r.block_id, r.registered) for r in j] == [(10, "2025-01-01")]
    p = project(recs, {"id": "block_id", "pk2": F.col("partition_key") * 2}).collect()
    assert [tuple(r) for r in p] == [(10, 2), (20, 4)]
    batch = recs.where("block_id = 20")
    assert [r.block_id for r in restrict_to_batch(recs, batch).collect()] == [20]
    t = recs.withColumn("modified_timestamp", F.col("block_id"))
    assert t.where(changed_since(t)).count() == 1


def _scan_metrics(df):
    plan = df._jdf.queryExecution().executedPlan()
    stack = [plan]
    while stack:
        node = stack.pop()
        if "Scan" in node.nodeName():
            ms = node.metrics()
            return {k: ms.apply(k).value() for k in ("numFiles", "numOutputRows")}
        it = node.children().iterator()
        while it.hasNext():
            stack.append(it.next())
    return {}


def test_file_time_watermark_prunes_files(spark, tmp_dir):
    import datetime as dt
    import json
    import os
    import time

    from ledgerline.operators import since
    from ledgerline.sources.files import scan_all
    for i in range(3):
        p = os.path.join(tmp_dir, f"{i}_x.json")
        with open(p, "w") as f:
            f.write(json.dumps({"value": {"BLOCK_ID": i}, "data": {}}) + "\n")
        os.utime(p, (time.time() - 3600 * (3 - i),) * 2)
    mark = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(minutes=90)
    q = since(scan_all(spark, tmp_dir), "inserted_timestamp", mark)
    assert q.count() == 1
    q.collect()
    assert _scan_metrics(q)["numFiles"] == 1      # older files are never opened


def test_gold_recency_suite(spark):
    from ledgerline.plans.checks import gold_recency
    fresh = spark.createDataFrame([("2025-01-02 10:00:00",)], "t string").select(
        F.to_timestamp_ntz("t").alias("modified_timestamp"))
    stale = spark.createDataFrame([("2025-01-02 05:00:00",)], "t string").select(
        F.to_timestamp_ntz("t").alias("modified_timestamp"))
    got = {r.tbl: r.status for r in gold_recency({"fact_blocks": fresh, "fact_msgs": stale},
                                                 "2025-01-02 11:00:00").collect()}
    assert got == {"fact_blocks": "pass", "fact_msgs": "error"}


def test_source_freshness_suite(spark):
    from ledgerline.plans.checks import source_freshness_checks

    def feed(t):
        return spark.createDataFrame([(t,)], "t string").select(
            F.to_timestamp_ntz("t").alias("inserted_timestamp"))
    got = {r.tbl: r.status for r in source_freshness_checks(
        {"blocks": feed("2025-01-02 10:00:00"), "transactions": feed("2025-01-02 08:30:00"),
         "tx_count": feed("2025-01-02 06:00:00")}, "2025-01-02 11:00:00").collect()}
    assert got == {"blocks": "pass", "transactions": "warn", "tx_count": "error"}


def test_gold_columns_carry_comments(spark, tmp_dir):
    from ledgerline.plans import gold
    df = spark.createDataFrame([(1, "t", True)], "block_id bigint, tx_id string, "
                               "tx_succeeded boolean").select(
        "block_id", F.lit(None).cast("timestamp_ntz").alias("block_timestamp"), "tx_id",
        "tx_succeeded", F.lit(0).alias("tx_code"), F.lit("").alias("codespace"),
        F.lit(None).cast("string").alias("tx_log"), F.lit(1).cast("bigint").alias("gas_used"),
        F.lit(2).cast("bigint").alias("gas_wanted"))
    f = gold.fact_transactions(df)
    f.write.parquet(f"{tmp_dir}/ft")
    back = spark.read.parquet(f"{tmp_dir}/ft").schema
    assert back["tx_id"].metadata["comment"] == "Transaction hash."


def test_landing_without_jvm_gateway(spark, tmp_dir, monkeypatch):
    """The fallbacks used when a session has no JVM gateway (Spark Connect)."""
    from ledgerline.sources import landing
    monkeypatch.setattr(landing, "_fs", lambda s, p: (None, None))
    assert not landing.table_exists(spark, f"{tmp_dir}/none")
    spark.range(3).write.parquet(f"{tmp_dir}/some")
    assert landing.table_exists(spark, f"{tmp_dir}/some")
    with pytest.raises(RuntimeError):                 # never a non-atomic landing
        landing.landed(spark, "t", f"{tmp_dir}/key", lambda: spark.range(3))


def test_silver_transactions_without_raw_payload(spark):
    from ledgerline.catalog import _bronze_txs
    from ledgerline.plans import silver
    from conftest import SF_SMALL
    b = _bronze_txs(spark, SF_SMALL)
    lean = silver.silver_transactions(b, keep_data=False)
    full = silver.silver_transactions(b)
    assert "data" not in lean.columns and "data" in full.columns
    cols = ["tx_id", "msg_group", "msg_sub_group", "msg_index"]
    assert sorted((tuple(r) for r in silver.silver_msgs(lean).select(*cols).collect()),
                  key=str) == \
        sorted((tuple(r) for r in silver.silver_msgs(full).select(*cols).collect()), key=str)


def test_worklist_batches_never_exceed_their_size(spark):
    from ledgerline.plans.fetching import with_batches
    wl = spark.createDataFrame([(b, p) for b in (3, 1, 2) for p in range(1, 11)] + [(None, 1)],
                               "block_id long, page_number long")
    rows = with_batches(wl, ["block_id", "page_number"], 4, 2).collect()
    sizes = [sum(r.batch_id == k for r in rows) for k in range(8)]
    assert sizes == [4] * 7 + [3]
    ordered = sorted((r for r in rows if r.block_id), key=lambda r: (r.block_id, r.page_number))
    assert [r.batch_id for r in ordered] == [(i + 1) // 4 for i in range(30)]
    assert all(sum((r.batch_id, r.worker_batch_id) == k for r in rows) <= 2
               for k in {(r.batch_id, r.worker_batch_id) for r in rows})


def test_incremental_scan_covers_everything_since_the_mark(spark, tmp_dir):
    import datetime as dt
    import os

    from ledgerline.sources.files import choose_scan
    now = dt.datetime(2025, 1, 20)
    for day in (1, 8, 19):
        with open(f"{tmp_dir}/{day}_a.json", "w") as f:
            f.write('{"value": {}, "data": {}}\n')
        at = dt.datetime(2025, 1, day, tzinfo=dt.timezone.utc).timestamp()
        os.utime(f"{tmp_dir}/{day}_a.json", (at, at))
    assert choose_scan(spark, tmp_dir, True, 3, now).count() == 1
    assert choose_scan(spark, tmp_dir, True, 3, now, mark=dt.datetime(2025, 1, 8)).count() == 2
    with pytest.raises(ValueError):
        choose_scan(spark, tmp_dir, True)
