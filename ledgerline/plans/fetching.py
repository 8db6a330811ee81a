"""Fetch planning (X8–X13): completion ledgers from landed records, the
chain head, and work-lists of requests still to make.

Work-lists hold every pending request; batches are numbered in the declared
order (D15). A caller that wants at most n requests per run passes ``limit``
(O3/O4), which plans as a distributed top-k (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rpc import block_request, tx_count_request, tx_search_request
from ..functions.text import surrogate_key
from ..functions.time import format_block_ts
from ..functions.variant import not_empty_array, vget, vget_first, vsize
from ..operators.joins import paginate, pending
from ..operators.windows import latest_by_key
from ..sources.files import number_sequence

# Batch sizes and page size of the fetcher (2 × 3,600 blocks per
# hour; 100 transactions per tx_search page).
BLOCKS_PER_HOUR = 3600
PRODUCER_BATCH = 2 * BLOCKS_PER_HOUR
PAGE_SIZE = 100


def chainhead(status: DataFrame) -> DataFrame:
    """Latest block height from stored ``status`` responses (one row)."""
    h = vget("data", "result.sync_info.latest_block_height", "bigint")
    return status.agg(F.max(h).alias("block_id"))


def wanted_blocks(spark, head: DataFrame, start: int = 0) -> DataFrame:
    """Wanted heights: every height up to the chain head."""
    hi = head.first()["block_id"]
    if hi is None:
        return spark.range(0).select(F.col("id").alias("block_id"))
    return number_sequence(spark, start, hi, "block_id")


def blocks_complete(bronze_blocks: DataFrame) -> DataFrame:
    """X11 ledger of landed blocks (both response shapes, D12); newest file wins."""
    d = F.col("data")
    paths = ("result.block", "block")
    df = bronze_blocks.select(
        vget_first(d, [f"{p}.header.height" for p in paths], "bigint").alias("block_id"),
        vget_first(d, [f"{p}.header.{f}" for f in ("time", "timestamp") for p in paths],
                   "timestamp_ntz").alias("block_timestamp"),
        F.coalesce(*[vsize(d, f"{p}.data.txs") for p in paths]).cast("bigint").alias("tx_count"),
        "file_name", "inserted_timestamp").where(F.col("block_id").isNotNull())
    df = latest_by_key(df, ["block_id"], [F.col("inserted_timestamp").desc(),
                                          F.col("file_name").desc()])
    return df.withColumn("complete_blocks_id", surrogate_key("block_id"))


def tx_count_complete(bronze_tx_counts: DataFrame) -> DataFrame:
    """X11 ledger of tx-count responses; ``block_id`` under either case."""
    df = bronze_tx_counts.select(
        vget_first("value", ["block_id", "BLOCK_ID"], "bigint").alias("block_id"),
        vget("data", "result.total_count", "bigint").alias("tx_count"),
        "file_name", "inserted_timestamp").where(F.col("block_id").isNotNull())
    df = latest_by_key(df, ["block_id"], [F.col("inserted_timestamp").desc(),
                                          F.col("file_name").desc()])
    return df.withColumn("complete_tx_counts_id", surrogate_key("block_id"))


def transactions_complete(bronze_txs: DataFrame) -> DataFrame:
    """X11 ledger of landed transaction pages (non-empty only)."""
    df = bronze_txs.where(not_empty_array("data")).select(
        vget("value", "BLOCK_ID_REQUESTED", "bigint").alias("block_id"),
        vget("value", "PAGE_NUMBER", "bigint").alias("page_number"),
        "file_name", "inserted_timestamp")
    df = latest_by_key(df, ["block_id", "page_number"], [F.col("inserted_timestamp").desc(),
                                                         F.col("file_name").desc()])
    return df.withColumn("complete_transactions_id", surrogate_key("block_id", "page_number"))


def _at_most(requests: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    return requests if limit is None else requests.orderBy(*order).limit(limit)


def pending_blocks(wanted: DataFrame, done: DataFrame, limit: int | None = None
                   ) -> DataFrame:
    """Heights not landed yet → ``block`` requests, bucket key round(−4)."""
    p = pending(wanted, done, ["block_id"])
    return _at_most(p.select(F.round("block_id", -4).cast("int").alias("partition_key"), "block_id",
                             block_request("block_id").alias("request")), ["block_id"], limit)


def pending_tx_counts(wanted: DataFrame, done: DataFrame, limit: int | None = None
                      ) -> DataFrame:
    """Heights without a tx count → ``tx_search`` page 1 of size 1."""
    p = pending(wanted, done, ["block_id"])
    return _at_most(p.select(F.round("block_id", -3).cast("int").alias("partition_key"), "block_id",
                             tx_count_request("block_id").alias("request")), ["block_id"], limit)


def pending_tx_pages(blocks: DataFrame, done_pages: DataFrame, page_size: int = PAGE_SIZE,
                     limit: int | None = None) -> DataFrame:
    """Pages ``1 … ceil(tx_count / page_size)`` of blocks with
    transactions, minus pages already landed (anti-join on (block_id,
    page_number), D6) → ``tx_search`` requests."""
    pages = paginate(blocks.select("block_id", "block_timestamp", "tx_count"), "tx_count",
                     page_size)
    todo = pages.join(done_pages.select("block_id", "page_number"),
                      ["block_id", "page_number"], "left_anti")
    return _at_most(
        todo.select(F.round("block_id", -3).cast("int").alias("partition_key"),
                    tx_search_request("block_id", "page_number", page_size).alias("request"),
                    "page_number", F.col("block_id").alias("block_id_requested"),
                    format_block_ts("block_timestamp").alias("block_timestamp")),
        ["block_id_requested", "page_number"], limit)


def with_batches(worklist: DataFrame, order_by: str | list[str], batch_size: int,
                 worker_batch_size: int | None = None) -> DataFrame:
    """Producer batch id = ``floor((row_number − 1) / batch_size)`` in work-list
    order, from a distributed prefix count over range buckets of the first
    order column (no global single-task window); optionally a worker batch id
    within it (``worker_batch_size``, e.g. 3,600 of a 7,200-request batch).
    Rows are numbered, so no batch exceeds its size whatever the ties; order
    by a unique key for the same batches on every run."""
    from ..operators.windows import rank0
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ranked = rank0(worklist, None, order, "__rn", ties=False,
                   bucket=F.floor(F.col(order[0]) / F.lit(max(batch_size, 1))))
    out = ranked.withColumn("batch_id", F.floor(F.col("__rn") / batch_size).cast("bigint"))
    if worker_batch_size:
        out = out.withColumn("worker_batch_id",
                             F.floor((F.col("__rn") % batch_size) / worker_batch_size)
                             .cast("bigint"))
    return out.drop("__rn")
