"""Growth of the chain models' disk and memory: what is landed for a query, and
that a transaction's events are grouped without sorting them."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline import run_queries
from ledgerline.catalog import QUERIES
from ledgerline.plans import silver
from ledgerline.session import checkpoint_dir
from ledgerline.sources import derived as D
from ledgerline.sources.landing import landed_json
from ledgerline.tables import load


def test_a_block_query_lands_blocks_only(spark):
    root = run_queries._landing(spark, SF_SMALL, "blocks").replace("file:", "")
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["blocks"]


def test_landed_records_are_compressed_one_file_a_folder(spark):
    root = run_queries._landing(spark, SF_SMALL, "transactions").replace("file:", "")
    files = glob.glob(f"{root}/transactions/*/*/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert len({os.path.dirname(f) for f in files}) == len(files)
    keys = spark.read.text(files).select(F.get_json_object("value", "$.value.BLOCK_ID_REQUESTED").cast("bigint").alias("k"),
                                         F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("pk"))
    assert keys.where(F.round("k", -3).cast("string") != F.col("pk")).count() == 0
    assert keys.count() == D.tx_versions(load(spark, SF_SMALL, "lineitem")).count()


def test_landed_waves_have_their_times(spark):
    rows = spark.createDataFrame([(0, 10, "a"), (0, 20, "b"), (2, 10, "c")], "wave int, pk int, value string")
    at = {0: dt.datetime(2025, 1, 2), 2: dt.datetime(2025, 1, 12)}
    root = landed_json(spark, "growth_times", os.urandom(8).hex(),
                       lambda: {"f": rows.withColumn("data", F.lit(1)).coalesce(1)}, at).replace("file:", "")
    for wave, pk in ((0, 10), (0, 20), (2, 10)):
        (f,) = glob.glob(f"{root}/f/{wave}/{pk}/part-*")
        assert os.path.getmtime(f) == at[wave].replace(tzinfo=dt.timezone.utc).timestamp()


def test_landed_tables_are_small(spark):
    QUERIES["transactions_complete"](spark, SF_SMALL).count()
    made = glob.glob(f"{checkpoint_dir(spark).replace('file:', '')}/landed/bronze_transactions_p2-*/part-*")
    assert made and all(f.endswith(".zstd.parquet") or f.endswith(".zst.parquet") or ".zstd." in f for f in made)


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_making_records_is_compiled(spark):
    # the JVM interprets methods of more than 8,000 bytes; a cut lineage: no adaptive plan
    lineitem = load(spark, SF_SMALL, "lineitem")
    for records in (D.tx_records(D.tx_versions(lineitem).localCheckpoint()),
                    D.block_records(D.block_versions(load(spark, SF_SMALL, "orders"), lineitem).localCheckpoint())):
        code = records._jdf.queryExecution().debug().codegenToSeq()
        assert code.size() == 1
        assert code.apply(0)._3().maxMethodCodeSize() < 8000


def test_landed_pages_are_empty_or_whole(spark):
    rows = spark.createDataFrame(
        [(50, 1, 7, 3, 2.0, "R", dt.datetime(2024, 1, 2), v) for v in (0, 1, 2)]
        + [(None, None, None, None, None, None, None, v) for v in (0, 2)],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp_ntz, ver int")
    got = D.tx_records(rows, 100, "l_orderkey", "ver").select(
        "l_orderkey", "ver", F.to_json("data").alias("d"),
        F.expr("try_variant_get(data, '$.tx_result.gas_used', 'bigint')").alias("gas")).collect()
    data = {(r.l_orderkey, r.ver): r.d for r in got}
    assert data[50, 2] == data[None, 2] == "[]"
    assert json.loads(data[50, 0])["index"] == 0 and len(json.loads(data[50, 0])["tx_result"]["events"]) == 5
    assert json.loads(data[None, 0])["tx_result"]["code"] == 5
    assert sorted(r.gas for r in got if r.gas is not None) == [2000, 2001]


def test_events_and_logs_are_grouped_without_sorting_them(spark):
    txs = D.bronze_transactions(load(spark, SF_SMALL, "lineitem"))
    txs = silver.silver_transactions(txs).localCheckpoint()
    plan = _plan(silver.silver_msg_attributes(silver.silver_msgs(txs)))
    assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan
    plan = _plan(silver.normalize_logs(txs))
    assert "Generate" not in plan and "Aggregate" not in plan


def test_groups_in_a_row_are_those_of_the_windows(spark):
    kinds = [[], ["o"], ["a"], ["e"], ["m", "o"], ["o", "m", "e", "m", "o", "m", "m", "o", "a", "m", "e", "o", "e", "m"]]
    names = {"o": ("message", "other", "x"), "a": ("message", "action", "/x.MsgSend"),
             "e": ("message", "action", "/x.MsgExec"), "m": ("message", "module", "bank")}
    rows = []
    for n, codes in enumerate(kinds):
        ev = [{"type": t, "attributes": [{"key": k, "value": v}]} for t, k, v in map(names.get, codes)]
        ev += [{"type": "message"}, {"type": None, "attributes": []}] if n == 5 else []
        rows.append((n, f"t{n}", json.dumps(ev)))
    df = spark.createDataFrame(rows, "block_id bigint, tx_id string, j string").select(
        "block_id", F.lit(None).cast("timestamp_ntz").alias("block_timestamp"), "tx_id", F.lit(True).alias("tx_succeeded"),
        F.parse_json("j").alias("msgs"), F.lit(None).cast("timestamp_ntz").alias("_inserted_timestamp"))
    cols = ["tx_id", "msg_index", "msg_type", "msg_group", "msg_sub_group"]

    def got(d):
        return sorted((tuple(r) for r in d.select(*cols).collect()), key=str)
    assert got(silver.silver_msgs(df)) == got(silver.msg_groups(silver.flatten_events(df)))
    assert len(got(silver.silver_msgs(df))) == 21


def test_a_huge_transaction_is_grouped_in_linear_time(spark):
    import time
    n = 60_000
    kind = F.col("id") % 4
    key = F.when(kind == 1, "action").when(kind == 0, "other").otherwise("module")
    value = F.when(kind == 1, F.when(F.col("id") % 8 == 1, "/x.MsgExec").otherwise("/x.MsgSend")).otherwise("bank")
    e = F.struct("id", F.lit("message").alias("type"), F.array(F.struct(key.alias("key"), value.alias("value"))).alias("attributes"))
    tx = spark.range(n).agg(F.sort_array(F.collect_list(e)).alias("events")).select(
        F.lit(1).cast("bigint").alias("block_id"), F.lit("t").alias("tx_id"), F.lit(True).alias("tx_succeeded"),
        F.lit(None).cast("timestamp_ntz").alias("block_timestamp"), F.lit(None).cast("timestamp_ntz").alias("_inserted_timestamp"),
        F.parse_json(F.to_json("events")).alias("msgs"))
    t = time.perf_counter()
    rows = silver.silver_msgs(tx).select("msg_index", "msg_group", "msg_sub_group").orderBy("msg_index").collect()
    assert time.perf_counter() - t < 60
    want = [None if i < 1 else ((i - 1) // 4, [0, 0, 1, 0][(i - 1) % 4] if i % 8 in (1, 2, 3, 4) else 0) for i in range(n)]
    assert [None if r.msg_group is None else (r.msg_group, r.msg_sub_group) for r in rows] == want
