"""Gold facts: projections of silver with their own surrogate keys.

Merge keys are the keys each fact actually carries (D1–D3 fixed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import surrogate_key
from ..operators.incremental import with_audit

FACT_KEYS = {
    "fact_blocks": ["fact_blocks_id"],
    "fact_transactions": ["fact_transactions_id"],
    "fact_msgs": ["fact_msgs_id"],
    "fact_msg_attributes": ["fact_msg_attributes_id"],
    "fact_transactions_logs": ["transactions_logs_id"],
}


def _audit(df, run_ts, run_id):
    from .docs import document
    return document(df if run_ts is None else with_audit(df, run_ts, run_id or ""))


def fact_blocks(silver_blocks: DataFrame, run_ts=None, run_id=None) -> DataFrame:
    return _audit(silver_blocks.select(
        "blockchain", "block_id", "block_timestamp", "chain_id", "tx_count", "proposer_address",
        "validator_hash", surrogate_key("block_id").alias("fact_blocks_id")), run_ts, run_id)


def fact_transactions(silver_txs: DataFrame, run_ts=None, run_id=None) -> DataFrame:
    return _audit(silver_txs.select(
        "block_id", "block_timestamp", "codespace", "tx_id", "tx_succeeded", "tx_code", "tx_log",
        "gas_used", "gas_wanted", surrogate_key("tx_id").alias("fact_transactions_id")),
        run_ts, run_id)


def msg_group_label(group: str = "msg_group", sub: str = "msg_sub_group"):
    """F14 ``group:subgroup``; NULL when either side is NULL."""
    return F.concat(F.col(group).cast("string"), F.lit(":"), F.col(sub).cast("string"))


def fact_msgs(silver_msgs: DataFrame, run_ts=None, run_id=None) -> DataFrame:
    return _audit(silver_msgs.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded",
        msg_group_label().alias("msg_group"), "msg_type", "msg_index", "msg",
        surrogate_key("tx_id", "msg_index").alias("fact_msgs_id")), run_ts, run_id)


def fact_msg_attributes(silver_attrs: DataFrame, run_ts=None, run_id=None) -> DataFrame:
    return _audit(silver_attrs.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "msg_group", "msg_sub_group",
        "msg_index", "msg_type", "attribute_index", "attribute_key", "attribute_value",
        surrogate_key("tx_id", "msg_index", "attribute_index").alias("fact_msg_attributes_id")),
        run_ts, run_id)


def fact_transactions_logs(silver_logs: DataFrame, run_ts=None, run_id=None) -> DataFrame:
    return _audit(silver_logs.select(
        "block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_code", "codespace", "tx_log",
        "transactions_logs_id"), run_ts, run_id)
