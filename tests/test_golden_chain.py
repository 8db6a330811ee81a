"""Golden records of FIXTURES.md §2 through the file scan and the silver/gold
transforms."""

import json
import os
import time

from pyspark.sql import functions as F

from ledgerline.plans import gold, observability, silver
from ledgerline.sources.files import scan_all, scan_recent

BLOCKS = [
    {"value": {"BLOCK_ID": 100}, "data": {"result": {"block": {"header": {
        "height": "100", "time": "2025-01-02T13:04:05.123456789Z", "chain_id": "c-1",
        "proposer_address": "AA", "validators_hash": "VV"}, "data": {"txs": ["t1", "t2"]}}}}},
    {"value": {"BLOCK_ID": 101}, "data": {"block": {"header": {
        "height": "101", "timestamp": "2025-01-02T13:04:11Z", "chain_id": "c-1",
        "proposer_address": "BB", "validators_hash": "VV"}, "data": {"txs": []}}}},
    {"value": {"BLOCK_ID": 102}, "data": {"error": {"code": -32603}}},
    {"value": {"BLOCK_ID": 103, "data": {"error": "timeout"}}, "data": {}},
    {"value": {"BLOCK_ID": 104}, "data": {"error": None, "result": {"block": {"header": {
        "height": "104", "chain_id": "c-1"}}}}},
    {"value": {}, "data": {"result": {"block": {"header": {"chain_id": "c-1"}}}}},
]
NEWER = [{"value": {"BLOCK_ID": 100}, "data": {"result": {"block": {"header": {
    "height": "100", "time": "2025-01-02T13:04:05.123456789Z", "chain_id": "c-1",
    "proposer_address": "CC", "validators_hash": "VV"}, "data": {"txs": ["t1", "t2"]}}}}}]


def _land(root, rel, records, mtime):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
    os.utime(p, (mtime, mtime))


def test_blocks_scan_dedupe_and_gap_audit(spark, tmp_dir):
    now = time.time()
    _land(tmp_dir, "blocks/1000_a.json", BLOCKS, now - 3600)
    _land(tmp_dir, "blocks/1000_b.json", NEWER, now - 60)
    bronze = scan_all(spark, tmp_dir)
    assert bronze.where("partition_key = 1000").count() == 7
    rows = {r.block_id: r for r in silver.silver_blocks(bronze).collect()}
    assert sorted(rows) == [100, 101]
    assert rows[100].proposer_address == "CC" and rows[100].tx_count == 2
    assert str(rows[100].block_timestamp) == "2025-01-02 13:04:05.123456"
    assert rows[101].tx_count == 0 and str(rows[101].block_timestamp) == "2025-01-02 13:04:11"
    # gap audit over the heights present in the ledger: {100, 101, 104}
    present = spark.createDataFrame([(100, None), (101, None), (104, None)],
                                    "block_id bigint, block_timestamp timestamp_ntz")
    r = observability.blocks_completeness(present, "2025-01-03 00:00:00").first()
    assert r.blocks_impacted_array == [102, 103] and r.blocks_impacted_count == 2
    assert r.blocks_tested == 5
    # incremental scan only sees recently modified files
    recent = scan_recent(spark, tmp_dir, days=1, now=__import__("datetime").datetime.now())
    assert recent.count() == 7


def _tx(spark, events, b64=False, tx_id="T"):
    import base64

    def enc(s):
        return base64.b64encode(s.encode()).decode() if b64 else s
    evs = [{"type": t, "attributes": [{"key": enc(k), "value": enc(v)}]} for t, k, v in events]
    rec = json.dumps({"events": evs})
    df = spark.createDataFrame([(1, tx_id, True, rec)], "block_id bigint, tx_id string, "
                               "tx_succeeded boolean, j string")
    return df.select("block_id", F.lit(None).cast("timestamp_ntz").alias("block_timestamp"),
                     "tx_id", "tx_succeeded",
                     F.lit(None).cast("timestamp_ntz").alias("_inserted_timestamp"),
                     F.try_variant_get(F.parse_json("j"), "$.events", "variant").alias("msgs"))


EVENTS = [("tx", "fee", "5uatom"), ("message", "action", "/cosmos.bank.v1beta1.MsgSend"),
          ("message", "module", "bank"), ("message", "action", "/cosmos.authz.v1beta1.MsgExec"),
          ("message", "module", "bank"), ("transfer", "recipient", "cosmos1a"),
          ("message", "module", "staking"), ("transfer", "recipient", "cosmos1b")]
EXPECT = [(None, None), (0, 0), (0, 0), (1, 0), (1, 0), (1, 1), (1, 1), (1, 0)]
LABELS = [None, "0:0", "0:0", "1:0", "1:0", "1:1", "1:1", "1:0"]


def test_message_grouping_plain_and_base64(spark):
    for b64 in (False, True):
        m = silver.silver_msgs(_tx(spark, EVENTS, b64)).orderBy("msg_index").collect()
        assert [(r.msg_group, r.msg_sub_group) for r in m] == EXPECT, b64
        f = gold.fact_msgs(silver.silver_msgs(_tx(spark, EVENTS, b64))).orderBy("msg_index")
        assert [r.msg_group for r in f.collect()] == LABELS


def test_attribute_decode_rules(spark):
    import base64
    k = base64.b64encode(b"amount").decode()
    rec = json.dumps({"events": [{"type": "transfer", "attributes": [
        {"key": "sender", "value": "abc"}, {"key": k, "value": "not base64!"},
        {"key": k, "value": base64.b64encode(b"5uatom").decode()}]}]})
    df = spark.createDataFrame([(1, "T", True, rec)], "block_id bigint, tx_id string, "
                               "tx_succeeded boolean, j string").select(
        "block_id", F.lit(None).cast("timestamp_ntz").alias("block_timestamp"), "tx_id",
        "tx_succeeded", F.lit(None).cast("timestamp_ntz").alias("_inserted_timestamp"),
        F.try_variant_get(F.parse_json("j"), "$.events", "variant").alias("msgs"))
    a = silver.silver_msg_attributes(silver.silver_msgs(df)).orderBy("attribute_index").collect()
    assert [(r.attribute_key, r.attribute_value) for r in a] == [
        ("sender", "abc"), ("amount", None), ("amount", "5uatom")]


LOGS = [
    ('{"0":{"msg_index":0,"events":[{"type":"transfer","attributes":'
     '[{"key":"a","value":"1"},{"key":"b"}]}]}}', 0,
     [(0, "transfer", [("a", "1"), ("b", "")])]),
    ('{"0":{"events":[{"type":"x","attributes":[{"key":"a","value":"1"}]}]}}', 0,
     [(0, "x", [("a", "1")])]),
    ('[{"msg_index":0,"events":[{"type":"y","attributes":[{"key":"a","value":"1"}]}]}]', 0,
     None),
    ('{"0":{"events":[]}}', 0, None),
    ("out of gas", 11, [(0, "error", [("error_message", "out of gas")])]),
    ("out of gas", 0, None),
    (None, 5, None),
]


def _log_txs(spark):
    rows = [(i, f"tx{i}", code == 0, code, log) for i, (log, code, _) in enumerate(LOGS)]
    df = spark.createDataFrame(rows, "block_id bigint, tx_id string, tx_succeeded boolean, "
                                     "tx_code int, log string")
    from ledgerline.functions import parse_or_text
    return df.select("block_id", F.lit(None).cast("timestamp_ntz").alias("block_timestamp"),
                     "tx_id", "tx_succeeded", "tx_code", F.lit("").alias("codespace"),
                     parse_or_text("log").alias("tx_log"),
                     F.lit(None).cast("timestamp_ntz").alias("_inserted_timestamp"))


def _shape(r):
    return [(e.msg_index, e.event_type, [(a.key, a.value) for a in e.attributes])
            for e in r.tx_log]


def test_log_normalisation(spark):
    out = {r.tx_id: _shape(r) for r in silver.normalize_logs(_log_txs(spark)).collect()}
    for i, (_, _, want) in enumerate(LOGS):
        if want is None:
            assert f"tx{i}" not in out
        else:
            assert out[f"tx{i}"] == want
    arr = {r.tx_id for r in silver.normalize_logs(_log_txs(spark), accept_arrays=True).collect()}
    assert "tx2" in arr


def test_priced_metrics_forward_fill(spark):
    from ledgerline.plans.stats import metrics_with_price
    stats = spark.createDataFrame(
        [(f"2025-01-02 0{h}:00:00", 10) for h in range(7)], "h string, g bigint").select(
        F.to_timestamp_ntz("h").alias("block_timestamp_hour"),
        F.col("g").alias("total_gas_used"))
    prices = spark.createDataFrame([("cosmos", "2025-01-02 01:00:00", 2.0),
                                    ("cosmos", "2025-01-02 04:00:00", 3.0),
                                    ("other", "2025-01-02 00:00:00", 9.0)],
                                   "id string, t string, close double").select(
        "id", F.to_timestamp_ntz("t").alias("recorded_hour"), "close")
    out = metrics_with_price(stats, prices, "cosmos", now="2025-01-02 06:30:00",
                             bucket_hours=2).orderBy("block_timestamp_hour").collect()
    assert [r.total_fees_usd for r in out] == [None, 20.0, 20.0, 20.0, 30.0, 30.0]


def test_a_huge_transaction_takes_linear_time(spark):
    """100,000 events in one transaction; a frame that looks ahead took minutes."""
    import time

    from pyspark.sql import functions as F

    from ledgerline.plans import silver
    n = 100_000
    kind = F.col("id") % 4
    key = F.when(kind == 1, "action").when(kind == 0, "other").otherwise("module")
    value = F.when(kind == 1, F.when(F.col("id") % 8 == 1, "/x.MsgExec").otherwise("/x.MsgSend")).otherwise("bank")
    ev = spark.range(n).select(
        F.lit(1).cast("bigint").alias("block_id"), F.lit("t").alias("tx_id"), F.col("id").cast("int").alias("msg_index"),
        F.to_json(F.struct(F.lit("message").alias("type"), F.array(F.struct(key.alias("key"), value.alias("value")))
                           .alias("attributes"))).alias("j")).withColumn("msg", F.parse_json("j")).drop("j")
    t = time.perf_counter()
    rows = silver.msg_groups(ev).select("msg_index", "msg_group", "msg_sub_group").orderBy("msg_index").collect()
    assert time.perf_counter() - t < 60
    # groups start at 1, 5, 9, ...; in exec groups the modules at +1 and +2 are markers 0 and 1
    want = [None if i < 1 else ((i - 1) // 4, [0, 0, 1, 0][(i - 1) % 4] if i % 8 in (1, 2, 3, 4) else 0) for i in range(n)]
    assert [None if r.msg_group is None else (r.msg_group, r.msg_sub_group) for r in rows] == want
