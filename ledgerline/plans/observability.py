"""Audits (X6 sequence gaps, X7 count reconciliation) with restart points.

An audit's impacted ids are an interval set: :func:`block_gaps` and
:func:`transaction_gaps` give them as a distributed table of maximal id ranges,
so an outage of a billion blocks is one row. The result row counts them from the
ranges; its array, which the result format asks for, lists every one of them,
however many (a row of Spark's holds up to 2 GB, about 2^28 ids: an audit of more
fails when its row is made, after its ranges are stored).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import settled_cond, ts_lit
from ..operators.gaps import expand_ranges, find_gaps, to_ranges
from ..operators.aggregates import ordered_array_by_group
from ..operators.joins import count_mismatch

CHUNK = 1 << 14


def sorted_id_array(ids: DataFrame, col: str, out: str) -> DataFrame:
    """One row holding ``ids.col`` ascending (A8), built from per-chunk
    sorted arrays; empty input → ``[]``."""
    return ordered_array_by_group(ids, [], col, out, CHUNK)


def _window(blocks: DataFrame, key: str, ts: str, now, settle_hours: int, restart) -> DataFrame:
    b = blocks
    if now is not None:
        b = b.where(settled_cond(ts, now, settle_hours))
    if restart is not None:
        b = b.where(F.col(key) >= F.lit(restart))
    return b


def _result(test_name: str, summary: DataFrame, ranges: DataFrame, run_ts) -> DataFrame:
    """One row: the summary, the number of impacted ids (summed from the ranges)
    and the ids."""
    t = ts_lit(run_ts)
    n = ranges.agg(F.coalesce(F.sum(F.col("range_end") - F.col("range_start") + 1), F.lit(0))
                   .cast("bigint").alias("__n"))
    one = summary.crossJoin(F.broadcast(n))                    # J8: 1 row × 1 row
    arr = sorted_id_array(expand_ranges(ranges, "range_start", "range_end", "block_id"), "block_id",
                          "blocks_impacted_array")
    return (arr.crossJoin(F.broadcast(one))
            .select(F.lit(test_name).alias("test_name"), "min_block", "max_block",
                    "min_block_timestamp", "max_block_timestamp", "blocks_tested",
                    F.col("__n").alias("blocks_impacted_count"), "blocks_impacted_array",
                    t.alias("test_timestamp"), t.alias("modified_timestamp")))


def blocks_impacted(blocks: DataFrame, key: str = "block_id") -> DataFrame:
    """Ids missing inside the id range, one row each."""
    return expand_ranges(find_gaps(blocks, key), "gap_start", "gap_end", "block_id")


def transactions_impacted(blocks: DataFrame, txs: DataFrame, key: str = "block_id",
                          count_col: str = "tx_count") -> DataFrame:
    """Ids of blocks whose declared count differs from the transactions present."""
    return count_mismatch(blocks.select(key, count_col), txs.select(key), key, count_col).select(
        F.col(key).cast("bigint").alias("block_id"))


def block_gaps(blocks: DataFrame, now=None, restart=None, key: str = "block_id",
               ts: str = "block_timestamp", settle_hours: int = 12) -> DataFrame:
    """X6 as ranges: (range_start, range_end) of ids missing inside the range of
    the settled blocks from ``restart`` on."""
    b = _window(blocks, key, ts, now, settle_hours, restart)
    return find_gaps(b, key).select(F.col("gap_start").alias("range_start"), F.col("gap_end").alias("range_end"))


def transaction_gaps(blocks: DataFrame, txs: DataFrame, now=None, restart=None,
                     key: str = "block_id", ts: str = "block_timestamp",
                     count_col: str = "tx_count", settle_hours: int = 12) -> DataFrame:
    """X7 as ranges: maximal runs of block ids whose declared ``tx_count`` differs
    from the transactions present. The same lower bound applies to the counted
    blocks (D14)."""
    t = txs.select(key)
    if restart is not None:
        t = t.where(F.col(key) >= F.lit(restart))
    return to_ranges(transactions_impacted(_window(blocks, key, ts, now, settle_hours, restart), t, key, count_col),
                     "block_id")


def blocks_completeness(blocks: DataFrame, run_ts, now=None, restart=None,
                        key: str = "block_id", ts: str = "block_timestamp",
                        settle_hours: int = 12, ranges: DataFrame | None = None) -> DataFrame:
    """Over settled blocks from ``restart`` on — id range, blocks tested
    (every id of the range), and the ids missing inside it. ``ranges``: the
    :func:`block_gaps` of the same arguments, if they are stored already."""
    b = _window(blocks, key, ts, now, settle_hours, restart)
    summary = b.agg(F.min(key).cast("bigint").alias("min_block"),
                    F.max(key).cast("bigint").alias("max_block"),
                    F.min(ts).alias("min_block_timestamp"),
                    F.max(ts).alias("max_block_timestamp")).withColumn(
        "blocks_tested", (F.col("max_block") - F.col("min_block") + 1).cast("bigint"))
    found = block_gaps(blocks, now, restart, key, ts, settle_hours) if ranges is None else ranges
    return _result("blocks", summary, found, run_ts)


def transactions_completeness(blocks: DataFrame, txs: DataFrame, run_ts, now=None,
                              restart=None, key: str = "block_id",
                              ts: str = "block_timestamp", count_col: str = "tx_count",
                              settle_hours: int = 12, ranges: DataFrame | None = None
                              ) -> DataFrame:
    """Blocks whose declared ``tx_count`` differs from the transactions
    present. ``ranges``: as in :func:`blocks_completeness`."""
    b = _window(blocks, key, ts, now, settle_hours, restart)
    summary = b.agg(F.min(key).cast("bigint").alias("min_block"),
                    F.max(key).cast("bigint").alias("max_block"),
                    F.min(ts).alias("min_block_timestamp"),
                    F.max(ts).alias("max_block_timestamp"),
                    F.count(F.lit(1)).cast("bigint").alias("blocks_tested"))
    found = (transaction_gaps(blocks, txs, now, restart, key, ts, count_col, settle_hours)
             if ranges is None else ranges)
    return _result("transactions", summary, found, run_ts)
