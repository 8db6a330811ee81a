"""Column documentation as Spark column metadata (``comment``); it is kept
in the Parquet schema, so readers of the tables see it."""

from __future__ import annotations

from pyspark.sql import DataFrame

COLUMN_DOCS = {
    "blockchain": "Name of the chain the record belongs to.",
    "block_id": "Block height.",
    "block_timestamp": "Block time (UTC, microseconds).",
    "chain_id": "Chain identifier from the block header.",
    "tx_count": "Number of transactions the block header declares.",
    "proposer_address": "Address of the validator that proposed the block.",
    "validator_hash": "Hash of the validator set of the block.",
    "tx_id": "Transaction hash.",
    "tx_index": "Position of the transaction in its block.",
    "tx_succeeded": "True when the transaction result code is 0.",
    "tx_code": "Transaction result code; 0 means success.",
    "codespace": "Module namespace of a non-zero result code.",
    "tx_log": "Transaction log: events grouped by message index and type.",
    "gas_used": "Gas the transaction consumed.",
    "gas_wanted": "Gas limit the transaction asked for.",
    "msg_group": "Action group of a message ('group:subgroup' in gold); NULL before the "
                 "first action.",
    "msg_sub_group": "Sub-group inside an exec action group; 0 elsewhere.",
    "msg_index": "Position of the event among the transaction's events.",
    "msg_type": "Event type.",
    "msg": "The event object.",
    "attribute_index": "Position of the attribute within its event.",
    "attribute_key": "Attribute key, base64-decoded when encoded.",
    "attribute_value": "Attribute value, base64-decoded when the key was encoded.",
    "block_timestamp_hour": "Hour bucket of the block time.",
    "total_fees_native": "Gas used in the hour.",
    "total_fees_usd": "Gas used in the hour times the latest known price.",
    "inserted_timestamp": "When the row was first written.",
    "modified_timestamp": "When the row was last written.",
    "_inserted_timestamp": "Landing time of the source record.",
    "_invocation_id": "Identifier of the run that wrote the row.",
}


def document(df: DataFrame, docs: dict[str, str] = COLUMN_DOCS) -> DataFrame:
    """Attach ``comment`` metadata to every documented column of ``df``."""
    out = df
    for c in df.columns:
        if c in docs:
            meta = dict(df.schema[c].metadata or {})
            meta["comment"] = docs[c]
            out = out.withMetadata(c, meta)
    return out
