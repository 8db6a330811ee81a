"""The table test-suites (§2.12) wired to the silver and gold tables.

Each suite is a union of one-pass check aggregates with the thresholds and
severities the tables are tested with; results are rows
``(check_name, tbl, col, failures, threshold, status)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import quality as Q

# The configured test parameters of the chain tables.
BLOCK_SEQUENCE_BREAKS_ALLOWED = 100
GOLD_RECENCY_HOURS = 3
SOURCE_WARN_HOURS = 2
SOURCE_ERROR_HOURS = 4


def silver_checks(blocks: DataFrame, txs: DataFrame, msgs: DataFrame | None = None,
                  attrs: DataFrame | None = None, logs: DataFrame | None = None
                  ) -> DataFrame:
    """silver_blocks: sequential block ids (error above 100 breaks), not-null
    ids / times / proposer / validator hash, ``tx_count >= 0``;
    silver_transactions: not-null block id, time and tx id; every table:
    its merge key is unique. Row-level checks of a table share one scan."""
    parts = [
        Q.sequential_values(blocks, "silver_blocks", "block_id", 1,
                            BLOCK_SEQUENCE_BREAKS_ALLOWED),
        Q.row_checks(blocks, "silver_blocks",
                     ["block_id", "block_timestamp", "proposer_address", "validator_hash"],
                     ["tx_count >= 0"]),
        Q.unique_key(blocks, "silver_blocks", ["blocks_id"]),
        Q.not_null(txs, "silver_transactions", ["block_id", "block_timestamp", "tx_id"]),
        Q.unique_key(txs, "silver_transactions", ["transactions_id"]),
    ]
    if msgs is not None:
        parts.append(Q.unique_key(msgs, "silver_msgs", ["msgs_id"]))
    if attrs is not None:
        parts.append(Q.unique_key(attrs, "silver_msg_attributes", ["msg_attributes_id"]))
    if logs is not None:
        parts.append(Q.unique_key(logs, "silver_transactions_logs", ["tx_id"]))
    return Q.run_checks(*parts)


def gold_recency(facts: dict[str, DataFrame], now, hours: int = GOLD_RECENCY_HOURS
                 ) -> DataFrame:
    """Every gold fact was modified within the last ``hours`` (error)."""
    return Q.run_checks(*[Q.recency(df, name, "modified_timestamp", now, hours=hours)
                          for name, df in facts.items()])


def source_freshness_checks(feeds: dict[str, DataFrame], now,
                            column: str = "inserted_timestamp") -> DataFrame:
    """Bronze feeds: newest landed record older than 2 h warns, 4 h errors."""
    return Q.run_checks(*[Q.source_freshness(df, name, column, now, SOURCE_WARN_HOURS,
                                             SOURCE_ERROR_HOURS)
                          for name, df in feeds.items()])
