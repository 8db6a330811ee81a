"""Registered queries that need landed files, several runs or a stream.

The chain's records are landed as JSON files in three waves, dated days apart,
with the path keys and file times that the file scans read (older copies come
first, the newest version of a repeated record last). Runs see the first two
waves, then all; the results are compared with relational oracles over the same
tables. Tables of a run live in the shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import catalog as C
from .catalog import _L, _TXID, D, S, _t, register
from .operators.joins import join_file_meta
from .plans import fetching, gold, models, observability
from .plans.bronze import bronze
from .plans.stats import HOUR
from .functions.text import partition_key_from_path
from .sources import layout, sinks
from .sources.files import choose_scan, scan_all
from .sources.landing import landed_json, scratch_folder
from .sources.versions import read_table
from .streaming import bronze_stream, follow_hours, latest_stream, stream_table, stream_upsert
from .streaming.live import epoch_of

#: Names of the queries in this module: several runs each, so not in bench.py's
#: default set.
RUNS: list[str] = []

#: Dates of the waves, and the runs' own times.
WAVES = {0: dt.datetime(2025, 1, 2), 1: dt.datetime(2025, 1, 7), 2: dt.datetime(2025, 1, 12)}
RUN_1, RUN_2 = "2025-01-08 00:00:00", "2025-01-13 00:00:00"
LATE = "2100-01-01 00:00:00"


def run_query(name: str, sql: str):
    RUNS.append(name)
    return register(name, sql)


def _spread(rows, key, digits, wave):
    """``rows`` with their wave and path key, those of a landed folder in one task
    and in its order: the small rows are shuffled and sorted, not their records."""
    at = rows.select("*", wave.cast("int").alias("wave"), F.round(key, digits).cast("int").alias("pk"))
    spark = rows.sparkSession
    # a number, so that the small rows are not put together to fewer tasks than there are cores
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return at.repartition(tasks, "wave", "pk").sortWithinPartitions("wave", "pk")


def _block_feed(spark, sf) -> DataFrame:
    rows = D.block_versions(_t(spark, sf, "orders"), _t(spark, sf, "lineitem"))
    k = F.col("o_orderkey")
    wave = F.when(F.col("ver") > 0, 0).when(k % 5 == 0, 2).otherwise(k % 3)
    return D.block_lines(_spread(rows, k, -4, wave), "wave", "pk")


def _tx_feed(spark, sf) -> DataFrame:
    rows = D.tx_versions(_t(spark, sf, "lineitem"))
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    twice = ((k % 7 == 0) | (k % 50 == 0)) & (F.coalesce(ln, F.lit(1)) == 1)
    wave = F.when(F.col("ver") > 0, 0).when(twice, 2).otherwise(k % 3)
    return D.tx_lines(_spread(rows, k, -3, wave), 100, "wave", "pk")


_FEEDS = {"blocks": _block_feed, "transactions": _tx_feed}


def _landing(spark, sf, feed: str) -> str:
    """Root of the landed files of one feed of these tables."""
    return landed_json(spark, f"json_{feed}", f"{sf}|{C._input_stamp(spark, sf)}",
                       lambda: {feed: _FEEDS[feed](spark, sf)}, WAVES, version=C._GEN_VERSION + "w3")


def _two_runs(spark, sf, feed: str, run) -> DataFrame:
    """``run(paths, n)`` over the first two waves' files, then over all."""
    root = f"{_landing(spark, sf, feed)}/{feed}"
    with models.cluster_grain("year"):
        run([f"{root}/0", f"{root}/1"], 1)
        return run(root, 2)


# ------------------------------------------------- landed files

@run_query("landed_full_scan", C.ORACLES["silver_blocks"])
def q_landed_full_scan(spark, sf):
    b = S.silver_blocks(bronze(spark, _landing(spark, sf, "blocks"), "blocks", incremental=False))
    return b.select("blockchain", "block_id", "block_timestamp", "chain_id", "tx_count",
                    "proposer_address", "validator_hash", "blocks_id")


_LANDED = """landed as (
  select o_orderkey as k, unnest(case when o_orderkey % 5 = 0 then [0, 1] else [0] end) as ver from orders),
waves as (select k, ver, cast(case when ver = 1 then 0 when k % 5 = 0 then 2 else k % 3 end as integer) as wave
  from landed)"""


@run_query("landed_recent_scan", f"""
with {_LANDED}
select cast(round(k, -4) as integer) as partition_key, count(*) as records
from waves where wave = 2 group by 1
""")
def q_landed_recent_scan(spark, sf):
    """An existing target reads the files of the last days only."""
    path = f"{_landing(spark, sf, "blocks")}/blocks"
    df = choose_scan(spark, path, True, days=3, now=WAVES[2] + dt.timedelta(hours=12), segment=-2)
    return df.groupBy("partition_key").agg(F.count(F.lit(1)).alias("records"))


@run_query("landed_file_registry", f"""
with {_LANDED}
select cast(round(k, -4) as integer) as partition_key, wave,
       (timestamp '2025-01-02 00:00:00' + to_days(5 * wave)) as file_time, count(*) as records
from waves group by 1, 2, 3
""")
def q_landed_file_registry(spark, sf):
    """Records joined with the registry of their files (one row a file)."""
    path = f"{_landing(spark, sf, "blocks")}/blocks"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        F.col("path").alias("file_name"), partition_key_from_path(F.col("path"), -2).alias("partition_key"),
        F.col("modificationTime").cast("timestamp_ntz").alias("file_time"))
    # the hidden metadata column writes file:/// where the reader lists file:/
    same = F.regexp_replace("file_name", "^file:/+", "file:/")
    rec = scan_all(spark, path, segment=-2).select("partition_key", same.alias("file_name"))
    j = join_file_meta(rec, files.withColumn("file_name", same), ("file_name", "partition_key"))
    wave = F.element_at(F.split("file_name", "/"), -3).cast("int")
    return j.groupBy("partition_key", wave.alias("wave"), "file_time").agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------- second runs

@run_query("blocks_two_runs", f"""
select q.*, case when block_id % 3 = 0 and block_id % 5 <> 0 then 'r1' else 'r2' end as _invocation_id,
       case when block_id % 3 = 0 and block_id % 5 <> 0 then timestamp '{RUN_1}' else timestamp '{RUN_2}' end
         as modified_timestamp
from ({C.ORACLES["silver_blocks"]}) q
""")
def q_blocks_two_runs(spark, sf):
    """The second run reads from the newest stored file time on
    (inclusive), so only blocks of the first wave keep the first run's columns."""
    path = scratch_folder(spark, "blocks")
    out = _two_runs(spark, sf, "blocks", lambda src, n: models.run_silver_blocks(
        spark, src, path, (RUN_1, RUN_2)[n - 1], f"r{n}"))
    return out.select("blockchain", "block_id", "block_timestamp", "chain_id", "tx_count", "proposer_address",
                      "validator_hash", "blocks_id", "_invocation_id", "modified_timestamp")


@run_query("ledger_two_runs", f"""
select o_orderkey as block_id, cast(coalesce(l.n, 0) as bigint) as tx_count,
       case when o_orderkey % 5 = 0 or o_orderkey % 3 in (0, 1) then timestamp '{RUN_1}'
            else timestamp '{RUN_2}' end as inserted_timestamp,
       case when o_orderkey % 5 = 0 or o_orderkey % 3 in (1, 2) then timestamp '{RUN_2}'
            else timestamp '{RUN_1}' end as modified_timestamp
from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) l
  on l.l_orderkey = o_orderkey
where o_orderkey % 97 <> 0
""")
def q_ledger_two_runs(spark, sf):
    """The merge keeps the first insert time."""
    path = scratch_folder(spark, "ledger")
    out = _two_runs(spark, sf, "blocks", lambda src, n: models.run_blocks_complete(
        spark, src, path, (RUN_1, RUN_2)[n - 1]))
    return out.select("block_id", "tx_count", "inserted_timestamp", "modified_timestamp")


def _txs_two_runs(spark, sf, then):
    """Two runs of the transactions model, each followed by ``then(txs, n)``."""
    path = scratch_folder(spark, "txs")

    def run(src, n):
        t = models.run_silver_transactions(spark, src, path, (RUN_1, RUN_2)[n - 1], f"r{n}", keep_data=True)
        return then(t, n)
    return _two_runs(spark, sf, "transactions", run)


@run_query("msgs_two_runs", C.ORACLES["silver_msgs"])
def q_msgs_two_runs(spark, sf):
    """Messages of the transactions of the last two dates, merged."""
    path = scratch_folder(spark, "msgs")
    out = _txs_two_runs(spark, sf, lambda t, n: models.run_silver_msgs(
        spark, t, path, (RUN_1, RUN_2)[n - 1], f"r{n}"))
    return out.select("block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_group",
                      "msg_sub_group", "msg_index", "msg_type", "msgs_id")


@run_query("metrics_two_runs", C.ORACLES["core_metrics_hourly"])
def q_metrics_two_runs(spark, sf):
    """The fact follows the modified time, the hours follow its commits."""
    root = scratch_folder(spark, "metrics")

    def then(t, n):
        at = (RUN_1, RUN_2)[n - 1]
        f = models.run_fact(spark, "fact_transactions", t, f"{root}/fact", at, f"r{n}")
        return models.run_core_metrics_hourly(spark, f, f"{root}/hours", at, f"r{n}", now=LATE)
    m = _txs_two_runs(spark, sf, then)
    return m.select(HOUR, "block_id_min", "block_id_max", "block_count", "transaction_count",
                    "transaction_count_success", "transaction_count_failed",
                    F.col("total_gas_used").cast("bigint").alias("total_gas_used"), "core_metrics_hourly_id")


@run_query("priced_two_runs", f"""
with {_L}, {C._PRICES},
st as (select cast(date_trunc('hour', l_shipdate) as timestamp) as h, count(*) as n,
              sum(cast(trunc(l_quantity * 1000) as bigint)) as gas from L group by 1),
f as (select st.*, last_value(cast(hi as double) ignore nulls) over (order by st.h
        rows between unbounded preceding and current row) as px from st left join pr on st.h = pr.h)
select h as block_timestamp_hour, n as transaction_count, cast(gas as bigint) as total_fees_native,
       cast(round(gas * px, 2) as double) as total_fees_usd
from f
""")
def q_priced_two_runs(spark, sf):
    """I8: priced hours from four hours before the earliest changed one."""
    root = scratch_folder(spark, "priced")
    prices = C._hourly_prices(spark, sf)

    def then(t, n):
        at = (RUN_1, RUN_2)[n - 1]
        f = models.run_fact(spark, "fact_transactions", t, f"{root}/fact", at, f"r{n}")
        m = models.run_core_metrics_hourly(spark, f, f"{root}/hours", at, f"r{n}", now=LATE)
        return models.run_ez_metrics(spark, m, prices, "cosmos", f"{root}/ez", at, now=LATE)
    ez = _txs_two_runs(spark, sf, then)
    return ez.select(HOUR, "transaction_count", F.col("total_fees_native").cast("bigint").alias("total_fees_native"),
                     "total_fees_usd")


_AUDITS = """
b as (select o_orderkey as k, case when o_orderkey % 5 = 0 or o_orderkey % 3 in (0, 1) then 1 else 2 end as run
      from orders where o_orderkey % 97 <> 0),
b1 as (select k from b where run = 1),
g1 as (select x from (select unnest(generate_series((select min(k) from b1), (select max(k) from b1))) as x)
       where x not in (select k from b1)),
b2 as (select k from b where k >= coalesce((select min(x) - 1 from g1), 0)),
g2 as (select x from (select unnest(generate_series((select min(k) from b2), (select max(k) from b2))) as x)
       where x not in (select k from b2))"""


@run_query("audit_two_runs", f"""
with {_AUDITS}
select timestamp '{RUN_1}' as test_timestamp, (select min(k) from b1) as min_block, (select max(k) from b1) as max_block,
       count(*) as blocks_impacted_count, cast(to_json(coalesce(list(x order by x), [])) as varchar) as impacted
from g1
union all
select timestamp '{RUN_2}', (select min(k) from b2), (select max(k) from b2), count(*),
       cast(to_json(coalesce(list(x order by x), [])) as varchar)
from g2
""")
def q_audit_two_runs(spark, sf):
    """The second audit restarts at the first one's smallest
    impacted id less one; each run stores its own partition."""
    root = scratch_folder(spark, "audit")

    def run(src, n):
        at = (RUN_1, RUN_2)[n - 1]
        s = models.run_silver_blocks(spark, src, f"{root}/blocks", at, f"r{n}")
        f = models.run_fact(spark, "fact_blocks", s, f"{root}/fact", at, f"r{n}")
        return models.run_blocks_audit(spark, f, f"{root}/audit", at, now=LATE)
    out = _two_runs(spark, sf, "blocks", run)
    return out.select("test_timestamp", "min_block", "max_block", "blocks_impacted_count",
                      F.to_json("blocks_impacted_array").alias("impacted"))


@register("impacted_ranges", f"""
with {_L},
n as (select l_orderkey, count(*) as n from lineitem group by 1),
d as (select l_orderkey, count(*) as c from L group by 1),
blk as (select o_orderkey as k, coalesce(n.n, 0) as tx_count from orders left join n on n.l_orderkey = o_orderkey
        where o_orderkey % 97 <> 0),
mm as (select k as x from blk left join d on d.l_orderkey = blk.k where coalesce(d.c, 0) <> blk.tx_count),
gaps as (select x from (select unnest(generate_series((select min(k) from blk), (select max(k) from blk))) as x)
         where x not in (select k from blk)),
ids as (select 'blocks' as test_name, x from gaps union all select 'transactions', x from mm),
g as (select test_name, x, x - row_number() over (partition by test_name order by x) as island from ids)
select test_name, min(x) as range_start, max(x) as range_end from g group by test_name, island
""")
def q_impacted_ranges(spark, sf):
    """X6, X7 as interval sets: every impacted id, one row per run of ids."""
    blocks = S.silver_blocks(C._bronze_blocks(spark, sf))
    txs = C._silver_txs(spark, sf)
    cols = ["test_name", "range_start", "range_end"]
    return (observability.block_gaps(blocks).withColumn("test_name", F.lit("blocks")).select(*cols)
            .unionByName(observability.transaction_gaps(blocks, txs)
                         .withColumn("test_name", F.lit("transactions")).select(*cols)))


@register("worklist_limited", f"""
select * from ({C.ORACLES["pending_blocks"]}) q order by block_id limit 500
""")
def q_worklist_limited(spark, sf):
    """O3: a run that asks for at most n requests gets the first n."""
    done = fetching.blocks_complete(C._bronze_blocks(spark, sf))
    return fetching.pending_blocks(C._wanted(spark, sf), done, limit=500)


# ------------------------------------------------------ layout

@run_query("compacted_lookup", f"""
with {_L}
select l_orderkey as block_id, {_TXID} as tx_id, cast(trunc(l_quantity * 1000) as bigint) as gas_used
from L where l_orderkey in (select l_orderkey from L order by {_TXID} limit 20)
""")
def q_compacted_lookup(spark, sf):
    """Appended facts, compacted and indexed; transactions found by
    their ids (a Bloom filter per file) give blocks, whose transactions are found
    by block id (a range per file)."""
    path = scratch_folder(spark, "lookup")
    f = gold.fact_transactions(C._silver_txs(spark, sf)).select("block_id", "tx_id", "gas_used", "block_timestamp")
    # three appends read the facts: they are landed, not deduplicated thrice
    f = sinks.stage(spark, f.withColumn("year", F.year("block_timestamp")))
    for n in range(3):
        sinks.append_table(spark, path, f.where(F.pmod(F.hash("tx_id"), F.lit(3)) == n), "year",
                           sort_by=["block_id"], bloom_cols=["tx_id"])
    layout.compact(spark, path, ["block_id"], ["tx_id"])
    layout.index_table(spark, path, ["block_id", "tx_id"])
    first = [r.tx_id for r in read_table(spark, path).select("tx_id").orderBy("tx_id").limit(20).collect()]
    blocks = [r.block_id for r in layout.lookup(spark, path, "tx_id", first).select("block_id").distinct().collect()]
    return layout.lookup(spark, path, "block_id", blocks).select(
        "block_id", "tx_id", F.col("gas_used").cast("bigint").alias("gas_used"))


# --------------------------------------------------------- streams

def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@run_query("stream_blocks", C.ORACLES["silver_blocks"])
def q_stream_blocks(spark, sf):
    """The landed files as a stream, each micro-batch one commit."""
    root = scratch_folder(spark, "stream_blocks")
    with models.cluster_grain("year"):
        _finish(stream_table(bronze_stream(spark, f"{_landing(spark, sf, "blocks")}/blocks", max_files_per_trigger=100),
                             S.silver_blocks, f"{root}/table", ["blocks_id"], "block_timestamp", f"{root}/checkpoint",
                             newest=["_inserted_timestamp"]))
    return read_table(spark, f"{root}/table").select(
        "blockchain", "block_id", "block_timestamp", "chain_id", "tx_count", "proposer_address",
        "validator_hash", "blocks_id")


@run_query("stream_hours", C.ORACLES["core_metrics_hourly"])
def q_stream_hours(spark, sf):
    """Later files change hours that were published already."""
    root = scratch_folder(spark, "stream_hours")
    raw = bronze_stream(spark, f"{_landing(spark, sf, "transactions")}/transactions", max_files_per_trigger=1_000)
    facts, hours = f"{root}/facts", f"{root}/hours"

    def sink(df, epoch):
        models.write_model(spark, facts, df, ["tx_id"], "block_timestamp", stream=epoch_of(df, epoch),
                           newest=["_inserted_timestamp"])
        follow_hours(spark, facts, hours)
    cols = ["block_id", "tx_id", "tx_succeeded", "gas_used", "block_timestamp", "_inserted_timestamp"]
    with models.cluster_grain("year"):
        _finish(stream_upsert(raw, lambda b: S.silver_transactions(b).select(*cols), sink, f"{root}/checkpoint"))
    return read_table(spark, hours).select(
        HOUR, "block_id_min", "block_id_max", "block_count", "transaction_count", "transaction_count_success",
        "transaction_count_failed", F.col("total_gas_used").cast("bigint").alias("total_gas_used"),
        "core_metrics_hourly_id")


@run_query("stream_latest", """
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) q
where rn = 1
""")
def q_stream_latest(spark, sf):
    """T4: events arrive shuffled; the newest of each user wins."""
    root = scratch_folder(spark, "stream_latest")
    ev = _t(spark, sf, "events")
    ev.repartition(4, F.xxhash64("event_id")).write.parquet(f"{root}/in")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")

    def sink(df, epoch):
        sinks.upsert_table(spark, f"{root}/table", df.withColumn("bucket", F.lit(0)), ["user_id"], "bucket",
                           moving=False, newest=["ts", "event_id"], stream=epoch_of(df, epoch))
    latest = latest_stream(s, ["user_id"], [("ts", True), ("event_id", True)])
    _finish(latest.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
            .foreachBatch(sink).trigger(availableNow=True).start())
    return read_table(spark, f"{root}/table").drop("bucket")
