"""Incremental model runs (§2.10 + §2.11): high-water mark → scan → transform
→ partition-scoped merge, one function per table.

Each run takes ``run_ts`` / ``run_id`` (audit columns, never the wall clock
inside a transform) and a ``full_refresh`` flag that is honoured only when
the table allows it (I10). Targets are versioned tables
(:mod:`ledgerline.sources.versions`) partitioned by a date or key bucket:
readers and crashes see one version. High-water marks compare like with like
(file time with the stored file time, D8), and a missing or empty target loads
everything (D18). A model that follows another model's table reads which hours
changed from that table's commits, not from its rows.
"""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import hour_floor, ts_lit
from ..operators.incremental import (high_watermark, min_changed_period, observability_restart,
                                     since)
from ..sources.files import parsed_once, scan_all, scan_since, source_path
from ..sources import versions
from ..sources.sinks import (load_watermarks, overwrite_table, replace_table_keys, upsert_table)
from ..sources.versions import exists, read_table
from . import fetching, gold, observability, silver, stats

DATE_KEY = "cluster_date"
BLOCK_KEY = "cluster_block"
# Partition grain of the model tables: a day holds ~14k blocks / millions of
# transactions on a live chain. Coarser grains suit sparse histories.
CLUSTER_GRAIN = {"grain": "day"}


def set_cluster_grain(grain: str) -> None:
    """``day`` (default), ``week``, ``month`` or ``year``."""
    CLUSTER_GRAIN["grain"] = grain


@contextlib.contextmanager
def cluster_grain(grain: str):
    """The grain of the tables written inside the block."""
    before = CLUSTER_GRAIN["grain"]
    set_cluster_grain(grain)
    try:
        yield
    finally:
        set_cluster_grain(before)


def cluster_value(col: str):
    return F.to_date(F.date_trunc(CLUSTER_GRAIN["grain"], F.col(col)))


def _target(spark: SparkSession, path: str, full_refresh: bool, allow_full_refresh: bool
            ) -> DataFrame | None:
    if full_refresh and not allow_full_refresh:
        full_refresh = False          # I10: the table ignores full-refresh requests
    if full_refresh or not exists(spark, path):
        return None
    return read_table(spark, path)


def _landed_scan(spark: SparkSession, root: str, hwm) -> DataFrame:
    """Landed records of files written at/after ``hwm``, whatever folder they
    are in: only the file time decides, so late files in old folders count."""
    if hwm is None:
        return parsed_once(scan_all(spark, root))
    return parsed_once(since(scan_since(spark, root, hwm), "inserted_timestamp", hwm))


def table_hwm(spark: SparkSession, path: str, target: DataFrame | None, col: str):
    """High-water mark of ``col``: the stored mark when the table keeps one
    (no scan), else ``max(col)`` over the table (first run after an upgrade)."""
    if target is None:
        return None
    stored = load_watermarks(spark, path).get(col)
    return stored if stored is not None else high_watermark(target, col)


def block_bucket(col: str = "block_id"):
    """ROUND(id, −3): a cluster key that never changes for a block."""
    return F.round(F.col(col), -3).cast("bigint")


def write_model(spark, path, df, keys, cluster, preserve=(), overwrite=False,
                track=("_inserted_timestamp", "modified_timestamp"), sort_by=(), moving=True,
                newest=(), stream=None):
    """Merge (or ``overwrite``) a model table. ``cluster``: the timestamp column
    whose date, or the expression, that the table is partitioned by. ``moving``: a
    key's partition may change between versions (its date is not part of the key).
    ``newest``, ``stream``: as in :func:`ledgerline.sources.sinks.upsert_table`."""
    if isinstance(cluster, str):
        df = df.withColumn(DATE_KEY, F.coalesce(cluster_value(cluster), F.lit("1970-01-01")
                                                .cast("date")))
        part, changed_ts = DATE_KEY, cluster
    else:
        df, part, changed_ts = df.withColumn(BLOCK_KEY, cluster), BLOCK_KEY, None
    track = [c for c in track if c in df.columns]
    blooms = [c for c in ("block_id", "tx_id") if c in df.columns]
    layout = {"sort_by": list(sort_by) or blooms, "bloom_cols": blooms, "track": track,
              "changed_ts": changed_ts, "stream": stream}
    if overwrite:
        overwrite_table(spark, path, df, part, **layout)
    else:
        upsert_table(spark, path, df, keys, part, preserve=preserve, moving=moving, newest=newest,
                     **layout)


def run_silver_blocks(spark: SparkSession, bronze_root: str, path: str, run_ts, run_id: str,
                      full_refresh: bool = False, allow_full_refresh: bool = False,
                      blockchain: str = "cosmos") -> DataFrame:
    """silver_blocks: merge on ``blocks_id``; rows from files at/after the
    newest stored file time (I1)."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    hwm = table_hwm(spark, path, target, "_inserted_timestamp")
    bronze = _landed_scan(spark, bronze_root, hwm)
    out = silver.silver_blocks(bronze, blockchain, run_ts, run_id)
    write_model(spark, path, out, ["blocks_id"], "block_timestamp", overwrite=target is None)
    return read_table(spark, path)


def run_silver_transactions(spark, bronze_root, path, run_ts, run_id, full_refresh=False,
                            allow_full_refresh=False, keep_data: bool = True) -> DataFrame:
    target = _target(spark, path, full_refresh, allow_full_refresh)
    hwm = table_hwm(spark, path, target, "_inserted_timestamp")
    bronze = _landed_scan(spark, bronze_root, hwm)
    out = silver.silver_transactions(bronze, run_ts, run_id, keep_data=keep_data)
    write_model(spark, path, out, ["transactions_id"], "block_timestamp", overwrite=target is None)
    return read_table(spark, path)


def run_silver_msgs(spark, txs: DataFrame, path, run_ts, run_id, lookback_days: int = 2,
                    full_refresh=False, allow_full_refresh=False) -> DataFrame:
    """silver_msgs: transactions of the last ``lookback_days`` dates."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    hwm = table_hwm(spark, path, target, "_inserted_timestamp")
    src = since(txs, "_inserted_timestamp", hwm, lookback_days=lookback_days, by_date=True)
    out = silver.silver_msgs(src, run_ts=run_ts, run_id=run_id, partition_input=True)
    write_model(spark, path, out, ["msgs_id"], "block_timestamp", overwrite=target is None)
    return read_table(spark, path)


def changes(spark, source: DataFrame, path: str) -> tuple[list[list[int]] | None, dict]:
    """What the table at ``path`` has to follow: the runs of hours that the
    ``source`` table's commits changed since the version it was computed from
    (None: not known, look at the rows), and the source version to record. Hours
    noted as still open are added."""
    src, snap = versions.origin(source), versions.snapshot(spark, path)
    if src is None:
        return None, {}
    seen = {src[0]: src[1]}
    if snap is None:
        return None, seen
    runs = versions.changed_hours(spark, src[0], snap.sources.get(src[0]), src[1])
    if runs is None:
        return None, seen
    return versions.joined_runs([*runs, *snap.notes.get("open_hours", [])]), seen


def _open_part(runs: list[list[int]], now) -> list[list[int]]:
    """The hours of ``runs`` that are not closed at ``now``."""
    if now is None:
        return []
    n = dt.datetime.fromisoformat(now) if isinstance(now, str) else now
    first = int((n - dt.datetime(1970, 1, 1)).total_seconds() // 3600)
    return [[max(lo, first), hi] for lo, hi in runs if hi >= first]


def hours_table(spark, runs: list[list[int]], col: str) -> DataFrame:
    """One row per hour of ``runs`` with its partition date. As many rows as the
    history has hours at most, whatever the number of facts."""
    hours = spark.createDataFrame([tuple(r) for r in runs], "lo long, hi long").select(
        F.explode(F.sequence("lo", "hi")).alias("h"))
    ts = F.timestamp_micros(F.col("h") * F.lit(3_600_000_000)).cast("timestamp_ntz")
    return hours.select(ts.alias(col)).withColumn(DATE_KEY, cluster_value(col))


def only_hours(facts: DataFrame, hours: DataFrame, col: str, ts: str) -> DataFrame:
    """The facts in ``hours``; where they are partitioned by date, only those
    dates' files are read."""
    if DATE_KEY in facts.columns:
        dates = [r[0] for r in hours.select(DATE_KEY).distinct().collect()]
        facts = facts.where(F.col(DATE_KEY).isin(dates))
    wanted = F.broadcast(hours.select(F.col(col).alias("__hour")))      # bounded: hours of the history
    return facts.join(wanted, hour_floor(ts) == F.col("__hour"), "left_semi")


def run_core_metrics_hourly(spark, fact_txs: DataFrame, path, run_ts, run_id, now,
                            full_refresh: bool = False, allow_full_refresh: bool = False
                            ) -> DataFrame | None:
    """silver core_metrics_hourly: delete+insert (I7); nothing changed → no run
    (D20). For a versioned fact table the changed hours come from its commits and
    only they are read and replaced (hours that lost all rows go). For any other
    input every hour from the earliest changed one is replaced, found by its
    modification times."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    runs, seen = changes(spark, fact_txs, path) if target is not None else (
        None, dict([versions.origin(fact_txs)]) if versions.origin(fact_txs) else {})
    min_hour, src, gone, notes = None, fact_txs, None, {"open_hours": []}
    if target is None and seen:
        # first load: the hours that are still open count as changes of the next run
        last = fact_txs.agg(F.max(hour_floor("block_timestamp"))).first()[0]
        if last is not None:
            notes["open_hours"] = _open_part([[0, int((last - dt.datetime(1970, 1, 1)).total_seconds() // 3600)]], now)
    if runs is not None:
        if not runs:
            return target
        notes["open_hours"] = _open_part(runs, now)
        gone = hours_table(spark, runs, "block_timestamp_hour")
        src = only_hours(fact_txs, gone, "block_timestamp_hour", "block_timestamp")
    elif target is not None:
        last = high_watermark(target, "modified_timestamp")
        min_hour = min_changed_period(fact_txs, "block_timestamp", "modified_timestamp", last)
        if min_hour is None:
            return target
    has_mod = "modified_timestamp" in fact_txs.columns
    m = stats.hourly_metrics(src, now=now, min_hour=min_hour,
                             modified="modified_timestamp" if has_mod else None)
    m = stats.with_metrics_key(m)
    if not has_mod:
        m = m.withColumn("_inserted_timestamp", ts_lit(run_ts))
    m = m.select(*m.columns, ts_lit(run_ts).alias("inserted_timestamp"),
                 ts_lit(run_ts).alias("modified_timestamp"), F.lit(run_id).alias("_invocation_id"))
    m = m.withColumn(DATE_KEY, cluster_value("block_timestamp_hour"))
    how = {"sort_by": ["block_timestamp_hour"], "track": ["modified_timestamp"],
           "changed_ts": "block_timestamp_hour", "sources": seen, "notes": notes}
    if target is None:
        overwrite_table(spark, path, m, DATE_KEY, **how)
    else:
        replace_table_keys(spark, path, m, ["block_timestamp_hour"], DATE_KEY, gone=gone, **how)
    return read_table(spark, path)


def run_ez_metrics(spark, metrics: DataFrame, prices: DataFrame, asset_id: str, path, run_ts,
                   now, default_start="2025-01-01 00:00:00", full_refresh: bool = False,
                   allow_full_refresh: bool = False) -> DataFrame:
    """gold ez_core_metrics_hourly: recompute from 4 h before the earliest
    changed hour (I8), which a versioned metrics table's commits name; the price
    fill runs over the full series first."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    min_hour, seen = None, dict([versions.origin(metrics)]) if versions.origin(metrics) else {}
    if target is not None:
        default = dt.datetime.fromisoformat(default_start)
        runs, _ = changes(spark, metrics, path)
        if runs is None:
            last = high_watermark(target, "modified_timestamp")
            min_hour = min_changed_period(metrics, "block_timestamp_hour", "modified_timestamp", last,
                                          lookback_hours=4, default=default)
        elif runs:
            min_hour = versions.hour_of(runs[0][0]) - dt.timedelta(hours=4)
        else:
            min_hour = default
    priced = stats.metrics_with_price(metrics, prices, asset_id, now=now, min_hour=min_hour)
    ez = stats.ez_metrics(priced)            # inserted/modified inherited from the stats rows
    if "modified_timestamp" not in ez.columns:
        ez = ez.select("*", ts_lit(run_ts).alias("inserted_timestamp"),
                       ts_lit(run_ts).alias("modified_timestamp"))
    ez = ez.withColumn(DATE_KEY, cluster_value("block_timestamp_hour"))
    how = {"sort_by": ["block_timestamp_hour"], "track": ["modified_timestamp"], "sources": seen}
    if target is None:
        overwrite_table(spark, path, ez, DATE_KEY, **how)
    else:
        replace_table_keys(spark, path, ez, ["block_timestamp_hour"], DATE_KEY, **how)
    return read_table(spark, path)


RUN_KEY = "test_run"


def _audit(spark, path, run_ts, now, blocks: DataFrame, full: bool, full_refresh: bool,
           allow_full_refresh: bool, find, result) -> DataFrame:
    """Store one audit run: its impacted ranges (table ``<path>_impacted``) and
    its result row. Both tables have one partition per test timestamp, so a run
    writes its own partition, a re-run replaces it, and no history is read or
    rewritten. The ranges are stored first and give the result row."""
    detail = f"{path.rstrip('/')}_impacted"
    fresh = full_refresh and allow_full_refresh
    prev = ranges = None
    if not fresh and exists(spark, path) and exists(spark, detail):
        other = F.col("test_timestamp") != ts_lit(run_ts)
        prev, ranges = (read_table(spark, p).where(other) for p in (path, detail))
        prev = prev if prev.limit(1).count() else None
    restart = observability_restart(blocks, prev, now, full=full or prev is None, prev_ranges=ranges)
    run = F.date_format(ts_lit(run_ts), "yyyyMMddHHmmss")

    def store(p, df):
        def attempt():
            snap = versions.snapshot(spark, p)
            mine = [] if snap is None else snap.named([_run_name(run_ts)])
            return versions.commit(spark, p, snap, df, RUN_KEY, drop=mine, fresh=fresh, operation="audit")
        versions.retried(attempt)
    found = find(restart).select("*", ts_lit(run_ts).alias("test_timestamp"), run.alias(RUN_KEY))
    store(detail, found)
    stored = versions.snapshot(spark, detail)
    mine = versions.read_parts(spark, detail, stored, stored.named([_run_name(run_ts)]))
    store(path, result(restart, mine).withColumn(RUN_KEY, run).coalesce(1))        # one row
    return read_table(spark, path).drop(RUN_KEY)


def _run_name(run_ts) -> str:
    t = dt.datetime.fromisoformat(run_ts) if isinstance(run_ts, str) else run_ts
    return t.strftime("%Y%m%d%H%M%S")


def run_blocks_audit(spark, fact_blocks: DataFrame, path, run_ts, now, full: bool = False,
                     full_refresh: bool = False, allow_full_refresh: bool = False) -> DataFrame:
    """observability blocks: one result row per test timestamp (a re-run
    replaces its own), restarting from the previous run's impacted ids (I9)."""
    return _audit(spark, path, run_ts, now, fact_blocks, full, full_refresh, allow_full_refresh,
                  lambda restart: observability.block_gaps(fact_blocks, now, restart),
                  lambda restart, ranges: observability.blocks_completeness(
                      fact_blocks, run_ts, now=now, restart=restart, ranges=ranges))


def run_transactions_audit(spark, fact_blocks: DataFrame, fact_txs: DataFrame, path, run_ts,
                           now, full: bool = False, full_refresh: bool = False,
                           allow_full_refresh: bool = False) -> DataFrame:
    return _audit(spark, path, run_ts, now, fact_blocks, full, full_refresh, allow_full_refresh,
                  lambda restart: observability.transaction_gaps(fact_blocks, fact_txs, now, restart),
                  lambda restart, ranges: observability.transactions_completeness(
                      fact_blocks, fact_txs, run_ts, now=now, restart=restart, ranges=ranges))


def impacted_ranges(spark, path) -> DataFrame:
    """The stored impacted id ranges of an audit table, per test timestamp."""
    return read_table(spark, f"{path.rstrip('/')}_impacted").drop(RUN_KEY)


def run_blocks_complete(spark, bronze_root, path, run_ts, **refresh) -> DataFrame:
    """complete_blocks ledger: merge on the block, first-insert time kept."""
    return _run_ledger(spark, bronze_root, path, run_ts, fetching.blocks_complete,
                       "complete_blocks_id", **refresh)


def run_silver_prices(spark, prices: DataFrame, asset_id: str, path, run_ts,
                      full_refresh: bool = False, allow_full_refresh: bool = False) -> DataFrame:
    """silver_hourly_prices: merge on (id, recorded_hour), rows modified at or
    after the stored high-water mark (I3), first-insert time kept (I5)."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    hwm = table_hwm(spark, path, target, "modified_timestamp")
    out = stats.silver_prices(prices, asset_id, run_ts)
    if hwm is not None and "modified_timestamp" in prices.columns:
        out = out.where(F.col("_source_modified") >= F.lit(hwm))
    out = out.drop("_source_modified").withColumn(DATE_KEY, cluster_value("recorded_hour"))
    layout = {"sort_by": ["id", "recorded_hour"], "track": ["modified_timestamp"],
              "changed_ts": "recorded_hour"}
    if target is None:
        overwrite_table(spark, path, out, DATE_KEY, **layout)
    else:
        upsert_table(spark, path, out, ["id", "recorded_hour"], DATE_KEY,
                     preserve=["inserted_timestamp"], moving=False, **layout)
    return read_table(spark, path)


def run_merge(spark: SparkSession, source: DataFrame, path: str, keys, cluster,
              run_ts, run_id: str, transform=None, hwm_col: str | None = None,
              source_col: str | None = None, lookback_days: int = 0, by_date: bool = False,
              preserve=(), full_refresh: bool = False, allow_full_refresh: bool = False,
              sort_by=(), moving: bool = True) -> DataFrame:
    """Generic incremental merge model: rows of ``source`` at/after the
    target's high-water mark (``hwm_col`` of the target vs ``source_col`` of
    the source, optional date-grained lookback) → ``transform`` → audit
    columns → partition-scoped upsert on ``keys``."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    src = source
    if hwm_col is not None:
        hwm = table_hwm(spark, path, target, hwm_col)
        src = since(source, source_col or hwm_col, hwm, lookback_days, by_date)
    out = transform(src) if transform else src
    if "_invocation_id" not in out.columns:
        out = out.select(*[c for c in out.columns
                           if c not in ("inserted_timestamp", "modified_timestamp")],
                         ts_lit(run_ts).alias("inserted_timestamp"),
                         ts_lit(run_ts).alias("modified_timestamp"),
                         F.lit(run_id).alias("_invocation_id"))
    write_model(spark, path, out, list(keys), cluster, preserve=preserve,
           overwrite=target is None, sort_by=sort_by, moving=moving)
    return read_table(spark, path)


def run_silver_msg_attributes(spark, msgs: DataFrame, path, run_ts, run_id,
                              lookback_days: int = 2, **refresh) -> DataFrame:
    return run_merge(spark, msgs, path, ["msg_attributes_id"], "block_timestamp", run_ts, run_id,
                     transform=lambda d: silver.silver_msg_attributes(d, run_ts=run_ts,
                                                                      run_id=run_id),
                     hwm_col="_inserted_timestamp", lookback_days=lookback_days, by_date=True,
                     **refresh)


def run_silver_transactions_logs(spark, txs: DataFrame, path, run_ts, run_id, **refresh
                                 ) -> DataFrame:
    return run_merge(spark, txs, path, ["tx_id"], "block_timestamp", run_ts, run_id,
                     transform=lambda d: silver.normalize_logs(d, run_ts=run_ts, run_id=run_id,
                                                               partition_input=True),
                     hwm_col="_inserted_timestamp", sort_by=("block_timestamp", "tx_id"),
                     **refresh)


FACTS = {
    "fact_blocks": (gold.fact_blocks, "fact_blocks_id"),
    "fact_transactions": (gold.fact_transactions, "fact_transactions_id"),
    "fact_msgs": (gold.fact_msgs, "fact_msgs_id"),
    "fact_msg_attributes": (gold.fact_msg_attributes, "fact_msg_attributes_id"),
    "fact_transactions_logs": (gold.fact_transactions_logs, "transactions_logs_id"),
}


def run_fact(spark, name: str, silver_table: DataFrame, path, run_ts, run_id, **refresh
             ) -> DataFrame:
    """Gold facts: silver rows modified at/after the fact's newest
    ``modified_timestamp`` (I3, D4 fixed) → projection → merge on its key."""
    fn, key = FACTS[name]
    return run_merge(spark, silver_table, path, [key], "block_timestamp", run_ts, run_id,
                     transform=lambda d: fn(d, run_ts, run_id), hwm_col="modified_timestamp",
                     **refresh)


def _run_ledger(spark, bronze_root, path, run_ts, transform, key: str, full_refresh: bool = False,
                allow_full_refresh: bool = False) -> DataFrame:
    """A completion ledger: records of files at/after its newest file time,
    merged on ``key``; the first insert time is kept (I5)."""
    target = _target(spark, path, full_refresh, allow_full_refresh)
    src = _landed_scan(spark, bronze_root, table_hwm(spark, path, target, "_inserted_timestamp"))
    led = transform(src).withColumnRenamed("inserted_timestamp", "_inserted_timestamp")
    led = led.select("*", ts_lit(run_ts).alias("inserted_timestamp"),
                     ts_lit(run_ts).alias("modified_timestamp"))
    write_model(spark, path, led, [key], block_bucket(), preserve=["inserted_timestamp"],
           overwrite=target is None, moving=False)
    return read_table(spark, path)


def run_transactions_complete(spark, bronze_root, path, run_ts, **refresh) -> DataFrame:
    """complete_transactions ledger (pages landed), first-insert time kept."""
    return _run_ledger(spark, bronze_root, path, run_ts, fetching.transactions_complete,
                       "complete_transactions_id", **refresh)


def run_tx_count_complete(spark, bronze_root, path, run_ts, **refresh) -> DataFrame:
    """complete_tx_counts ledger, first-insert time kept."""
    return _run_ledger(spark, bronze_root, path, run_ts, fetching.tx_count_complete,
                       "complete_tx_counts_id", **refresh)


def run_worklists(spark, status: DataFrame, blocks_done: DataFrame, tx_counts_done: DataFrame,
                  pages_done: DataFrame, out_root: str, limit: int | None = None,
                  batch_size: int = fetching.PRODUCER_BATCH,
                  worker_batch_size: int = fetching.BLOCKS_PER_HOUR,
                  page_size: int = fetching.PAGE_SIZE) -> dict:
    """One planning run: chain head → wanted heights → the three work-lists
    (blocks, tx counts, transaction pages), each published for the fetcher in
    producer batches (default: two hours of blocks) split into worker batches
    (default: one hour). Every pending request is listed unless ``limit`` is
    given. Returns the number of requests per list."""
    from ..sources.sinks import write_worklist
    wanted = fetching.wanted_blocks(spark, fetching.chainhead(status))
    lists = {
        "blocks": (fetching.pending_blocks(wanted, blocks_done, limit), "block_id"),
        "tx_counts": (fetching.pending_tx_counts(wanted, tx_counts_done, limit), "block_id"),
        "transactions": (fetching.pending_tx_pages(blocks_done, pages_done, page_size, limit),
                         ["block_id_requested", "page_number"]),
    }
    counts = {}
    for name, (wl, order) in lists.items():
        counts[name] = write_worklist(wl, f"{out_root.rstrip('/')}/{name}", order, batch_size,
                                      worker_batch_size=worker_batch_size)
    return counts


def _feeds(spark, landing_root: str) -> list[str]:
    from ..sources.landing import table_exists
    from .bronze import FEEDS
    return [f for f in FEEDS if table_exists(spark, source_path(landing_root, f))]


def source_freshness(spark, landing_root: str, now) -> DataFrame:
    """Q6: the newest landed file of every feed against the freshness limits. Only
    the folders are listed, no file is opened."""
    from . import checks

    def files(feed):
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .load(source_path(landing_root, feed))
                .select(F.col("modificationTime").cast("timestamp_ntz").alias("inserted_timestamp")))
    return checks.source_freshness_checks({f: files(f) for f in _feeds(spark, landing_root)}, now)


def run_planning(spark, landing_root: str, warehouse: str, status: DataFrame, run_ts,
                 limit: int | None = None, **refresh) -> dict:
    """The completion ledgers of every landed feed, then the work-lists of
    what is still to be fetched (``<warehouse>/worklists``). A feed without files
    has an empty ledger. Returns the ledgers by name and ``worklists``: the number
    of requests per list."""
    w, have = warehouse.rstrip("/"), _feeds(spark, landing_root)
    empty = {"blocks": "block_id bigint, block_timestamp timestamp_ntz, tx_count bigint",
             "tx_count": "block_id bigint, tx_count bigint",
             "transactions": "block_id bigint, page_number bigint"}
    ledgers = {"blocks": ("complete_blocks", run_blocks_complete),
               "tx_count": ("complete_tx_counts", run_tx_count_complete),
               "transactions": ("complete_transactions", run_transactions_complete)}
    out = {}
    for feed, (name, run) in ledgers.items():
        out[name] = (run(spark, source_path(landing_root, feed), f"{w}/{name}", run_ts, **refresh)
                     if feed in have else spark.createDataFrame([], empty[feed]))
    out["worklists"] = run_worklists(spark, status, out["complete_blocks"], out["complete_tx_counts"],
                                     out["complete_transactions"], f"{w}/worklists", limit=limit)
    return out


def run_chain(spark: SparkSession, landing_root: str, warehouse: str, run_ts, run_id: str,
              now, prices: DataFrame | None = None, asset_id: str = "cosmos",
              blockchain: str = "cosmos", status: DataFrame | None = None,
              full_refresh: bool = False, allow_full_refresh: bool = False) -> dict:
    """One scheduled run of the table models in dependency order (bronze folders
    ``<landing_root>/{blocks,transactions,tx_count}``, tables under ``warehouse``):
    silver blocks / transactions → messages → attributes, logs → the five gold facts →
    hourly metrics (→ the price table and priced metrics when ``prices`` is given) →
    audits → the silver test-suite and source freshness (→ ledgers and work-lists
    when ``status``, stored chain-head responses, is given). ``full_refresh`` rebuilds
    every table that allows it. Returns the results by name."""
    from . import checks
    w = warehouse.rstrip("/")
    refresh = {"full_refresh": full_refresh, "allow_full_refresh": allow_full_refresh}
    out = {}
    out["silver_blocks"] = run_silver_blocks(spark, f"{landing_root}/blocks", f"{w}/silver_blocks",
                                             run_ts, run_id, blockchain=blockchain, **refresh)
    out["silver_transactions"] = run_silver_transactions(
        spark, f"{landing_root}/transactions", f"{w}/silver_transactions", run_ts, run_id, **refresh)
    out["silver_msgs"] = run_silver_msgs(spark, out["silver_transactions"], f"{w}/silver_msgs",
                                         run_ts, run_id, **refresh)
    out["silver_msg_attributes"] = run_silver_msg_attributes(
        spark, out["silver_msgs"], f"{w}/silver_msg_attributes", run_ts, run_id, **refresh)
    out["silver_transactions_logs"] = run_silver_transactions_logs(
        spark, out["silver_transactions"], f"{w}/silver_transactions_logs", run_ts, run_id, **refresh)
    sources = {"fact_blocks": "silver_blocks", "fact_transactions": "silver_transactions",
               "fact_msgs": "silver_msgs", "fact_msg_attributes": "silver_msg_attributes",
               "fact_transactions_logs": "silver_transactions_logs"}
    for fact, src in sources.items():
        out[fact] = run_fact(spark, fact, out[src], f"{w}/{fact}", run_ts, run_id, **refresh)
    out["core_metrics_hourly"] = run_core_metrics_hourly(
        spark, out["fact_transactions"], f"{w}/core_metrics_hourly", run_ts, run_id, now, **refresh)
    if prices is not None:
        out["silver_hourly_prices"] = run_silver_prices(spark, prices, asset_id, f"{w}/silver_hourly_prices",
                                                        run_ts, **refresh)
        out["ez_core_metrics_hourly"] = run_ez_metrics(
            spark, out["core_metrics_hourly"], out["silver_hourly_prices"], asset_id,
            f"{w}/ez_core_metrics_hourly", run_ts, now, **refresh)
    out["blocks_completeness"] = run_blocks_audit(spark, out["fact_blocks"],
                                                  f"{w}/blocks_completeness", run_ts, now, **refresh)
    out["transactions_completeness"] = run_transactions_audit(
        spark, out["fact_blocks"], out["fact_transactions"], f"{w}/transactions_completeness",
        run_ts, now, **refresh)
    out["silver_checks"] = checks.silver_checks(out["silver_blocks"], out["silver_transactions"],
                                                out["silver_msgs"], out["silver_msg_attributes"],
                                                out["silver_transactions_logs"])
    out["source_freshness"] = source_freshness(spark, landing_root, now)
    if status is not None:
        out.update(run_planning(spark, landing_root, warehouse, status, run_ts, **refresh))
    return out
