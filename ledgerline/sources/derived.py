"""Chain-shaped bronze records derived by Spark from the analytics tables.

The record layout is the landed JSON-RPC shape (``value`` request metadata,
``data`` response, ``partition_key``, ``file_name``, ``inserted_timestamp``);
the content is a deterministic function of ``orders`` / ``lineitem`` so the
silver/gold transforms can run — and be checked relationally — on the driver
tables at any scale. Every branch of the transforms is hit:

blocks (one per order): odd keys lack the ``result`` level, multiples of 3
carry ``timestamp`` instead of ``time``, multiples of 97 are error responses,
multiples of 5 land twice (the older copy has another proposer).

transactions (one per deduplicated lineitem): code 5 for returned items with
a plain-text log, else an object-shaped log with two events; 4–9 events per
tx following the message layout of an authz/bank chain, keys and values base64
encoded on even block ids (amount values left plain when key % 10 = 4); every
7th block's first tx lands twice, every 50th block gets an empty ``[]`` page.
"""

from __future__ import annotations

import base64
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import format_block_ts
from ..functions.variant import ColumnOrName, _c
from ..operators.windows import latest_by_key

# Fixed values of the derived layout (shared with the relational oracles).
LANDED_AT = dt.datetime(2025, 1, 2)
NS_SUFFIX = ".123456789Z"
EXEC_ACTION = "/cosmos.authz.v1beta1.MsgExec"
SEND_ACTION = "/cosmos.bank.v1beta1.MsgSend"
FEE_VALUE = "5uatom"
MODULE_VALUE = "bank"
RECIPIENT_VALUE = "cosmos1abc"


def _ver_ts(ver: Column) -> Column:
    return (F.lit(LANDED_AT).cast("timestamp_ntz")
            - F.make_dt_interval(ver.cast("int"), F.lit(0), F.lit(0), F.lit(0)))


def dedup_lineitem(lineitem: DataFrame) -> DataFrame:
    """One row per (l_orderkey, l_linenumber): latest ship date, then ties."""
    return latest_by_key(lineitem, ["l_orderkey", "l_linenumber"],
                         [F.col("l_shipdate").desc(), "l_partkey", "l_suppkey",
                          "l_extendedprice"])


def tx_hash(orderkey: ColumnOrName, linenumber: ColumnOrName) -> Column:
    return F.md5(F.concat_ws("-", _c(orderkey).cast("string"), _c(linenumber).cast("string")))


def block_versions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The rows that block records are made of: one per landing (``ver`` 0: newest)."""
    n = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("__n"))
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").join(
        n, "o_orderkey", "left")
    return o.withColumn("ver", F.explode(F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit(0), F.lit(1)))
                                         .otherwise(F.array(F.lit(0)))))


def bronze_blocks(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return block_records(block_versions(orders, lineitem))


def _block_parts() -> tuple[Column, Column]:
    """``value`` and ``data`` of a block's record as JSON text."""
    k = F.col("o_orderkey")
    ts = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(NS_SUFFIX))
    header = F.struct(
        k.cast("string").alias("height"),
        F.when(k % 3 != 0, ts).alias("time"),
        F.when(k % 3 == 0, ts).alias("timestamp"),
        F.concat(F.lit("chain-"), F.col("o_orderstatus")).alias("chain_id"),
        F.concat(F.when(F.col("ver") == 0, F.lit("val")).otherwise(F.lit("old")),
                 F.col("o_custkey").cast("string")).alias("proposer_address"),
        F.concat(F.lit("vh-"), F.col("o_orderstatus")).alias("validators_hash"))
    block = F.struct(header.alias("header"),
                     F.struct(F.array_repeat(F.lit("dHg="), F.coalesce(F.col("__n"), F.lit(0))
                                             .cast("int")).alias("txs")).alias("data"))
    err = k % 97 == 0
    data = F.struct(
        F.when(~err & (k % 2 == 0), F.struct(block.alias("block"))).alias("result"),
        F.when(~err & (k % 2 == 1), block).alias("block"),
        F.when(err, F.struct(F.lit(-32603).alias("code"))).alias("error"))
    return F.to_json(F.struct(k.alias("BLOCK_ID"))), F.to_json(data)


def block_lines(rows: DataFrame, *extra: str) -> DataFrame:
    """The records of :func:`block_records` as landed JSON lines."""
    return rows.select(*extra, json_line(*_block_parts()))


def block_records(rows: DataFrame, *extra: str) -> DataFrame:
    """Landed records of :func:`block_versions`, with the ``extra`` columns of the rows."""
    value, data = _block_parts()
    pk = F.round("o_orderkey", -4).cast("int")
    return rows.select(
        *extra, F.parse_json(value).alias("value"), F.parse_json(data).alias("data"),
        pk.alias("partition_key"),
        F.concat(F.lit("blocks/"), pk.cast("string"), F.lit("_"), F.col("ver").cast("string"),
                 F.lit(".json")).alias("file_name"),
        _ver_ts(F.col("ver")).alias("inserted_timestamp"))


def _events(enc: Column, amount_plain: Column) -> Column:
    def b64(text: str) -> Column:
        return F.when(enc, F.lit(base64.b64encode(text.encode()).decode())).otherwise(F.lit(text))

    def event(kind: str, *attrs: tuple[str, Column]) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.array(*[
            F.struct(b64(k).alias("key"), v.alias("value")) for k, v in attrs]).alias("attributes"))

    amount = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit("uatom"))
    action = F.when(F.col("l_suppkey") % 2 == 0, b64(EXEC_ACTION)).otherwise(b64(SEND_ACTION))
    fee, act = event("tx", ("fee", b64(FEE_VALUE))), event("message", ("action", action))
    module = event("message", ("module", b64(MODULE_VALUE)))
    transfer = event("transfer", ("recipient", b64(RECIPIENT_VALUE)),
                     ("amount", F.when(~enc | amount_plain, amount).otherwise(F.base64(amount))))
    # every transaction begins this row of events; how far it goes depends on its part
    n = F.lit(4) + F.col("l_partkey") % 6
    every = F.array(fee, act, module, module, transfer, act, module, module, transfer)
    return F.slice(every, F.lit(1), F.when(n < 0, F.lit(0)).otherwise(n).cast("int"))


def _log(ok: Column) -> Column:
    attr = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    transfer = F.struct(F.lit("transfer").alias("type"), F.array(
        attr("a", F.col("l_partkey").cast("string")),
        attr("b", F.lit(None).cast("string"))).alias("attributes"))
    coin = F.struct(F.lit("coin").alias("type"), F.array(
        attr("s", F.col("l_suppkey").cast("string"))).alias("attributes"))
    obj = F.to_json(F.struct(F.struct(F.array(transfer, coin).alias("events")).alias("0")))
    return F.when(ok, obj).otherwise(F.concat(F.lit("err "), F.col("l_partkey").cast("string")))


def tx_versions(lineitem: DataFrame) -> DataFrame:
    """The rows that transaction records are made of: one per landing (``ver`` 0:
    newest, 1: older copy, 2: empty page)."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return dedup_lineitem(lineitem).withColumn("ver", F.explode(
        F.when((k % 7 == 0) & (ln == 1), F.array(F.lit(0), F.lit(1)))
         .when((k % 50 == 0) & (ln == 1), F.array(F.lit(0), F.lit(2)))
         .otherwise(F.array(F.lit(0)))))


def bronze_transactions(lineitem: DataFrame, page_size: int = 100) -> DataFrame:
    return tx_records(tx_versions(lineitem), page_size)


def _tx_parts(page_size: int) -> tuple[Column, Column]:
    """``value`` and, but for empty pages, ``data`` of a transaction's record as structs."""
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    ok = F.col("l_returnflag") != "R"
    gas = (F.col("l_quantity") * 1000).cast("bigint") + F.when(F.col("ver") == 1, 1).otherwise(0)
    tx_result = F.struct(
        F.when(ok, F.lit("")).otherwise(F.lit("sdk")).alias("codespace"),
        F.when(ok, F.lit(0)).otherwise(F.lit(5)).alias("code"),
        gas.cast("string").alias("gas_used"),
        (gas + 500).cast("string").alias("gas_wanted"),
        _log(ok).alias("log"),
        _events(k % 2 == 0, k % 10 == 4).alias("events"))
    value = F.struct(
        k.alias("BLOCK_ID_REQUESTED"), format_block_ts("l_shipdate").alias("BLOCK_TIMESTAMP"),
        F.ceil(ln / F.lit(page_size)).cast("int").alias("PAGE_NUMBER"))
    return value, F.struct(tx_hash(k, ln).alias("hash"), (ln - 1).alias("index"), tx_result.alias("tx_result"))


def _or_empty_page(data: Column, empty: Column) -> Column:
    """An empty page's data is picked from an array: in the branch of a condition Spark
    neither shares common parts of the record nor keeps its code small enough for the
    JVM to compile (8,000 bytes a method)."""
    return F.get(F.array(data, empty), F.when(F.col("ver") == 2, 1).otherwise(0))


def json_line(value: Column, data: Column) -> Column:
    """A landed line of the texts of its two parts."""
    return F.concat(F.lit('{"value":'), value, F.lit(',"data":'), data, F.lit("}")).alias("line")


def tx_lines(rows: DataFrame, page_size: int = 100, *extra: str) -> DataFrame:
    """The records of :func:`tx_records` as landed JSON lines, written straight from
    their fields: the text of a variant costs several times that of a struct."""
    value, data = (F.to_json(c, {"ignoreNullFields": "false"}) for c in _tx_parts(page_size))
    return rows.select(*extra, json_line(value, _or_empty_page(data, F.lit("[]"))))


def tx_records(rows: DataFrame, page_size: int = 100, *extra: str) -> DataFrame:
    """Landed records of :func:`tx_versions`, with the ``extra`` columns of the rows."""
    # built as variants: a text of them would only be parsed again
    value, data = (F.to_variant_object(c) for c in _tx_parts(page_size))
    data = _or_empty_page(data, F.parse_json(F.lit("[]")))
    pk = F.round("l_orderkey", -3).cast("int")
    return rows.select(
        *extra, value.alias("value"), data.alias("data"),
        pk.alias("partition_key"),
        F.concat(F.lit("transactions/"), pk.cast("string"), F.lit("_"),
                 F.col("ver").cast("string"), F.lit(".json")).alias("file_name"),
        _ver_ts(F.col("ver")).alias("inserted_timestamp"))


def bronze_tx_counts(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """tx_count responses (``result.total_count``) — one per order with lines."""
    n = lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        F.parse_json(F.to_json(F.struct(F.col("k").alias("block_id")))).alias("value"),
        F.parse_json(F.to_json(F.struct(F.struct(F.col("n").cast("string").alias("total_count"))
                                        .alias("result")))).alias("data"),
        F.round("k", -3).cast("int").alias("partition_key"),
        F.lit("tx_count/0.json").alias("file_name"),
        F.lit(LANDED_AT).cast("timestamp_ntz").alias("inserted_timestamp"))


HEAD_AHEAD = 10   # the chain head runs this many heights past the newest order


def bronze_status(orders: DataFrame) -> DataFrame:
    """A stored ``status`` response whose head is the newest order + HEAD_AHEAD."""
    h = (F.max("o_orderkey") + HEAD_AHEAD).cast("string")
    return orders.agg(F.parse_json(F.to_json(F.struct(F.struct(F.struct(
        h.alias("latest_block_height")).alias("sync_info")).alias("result")))).alias("data"))
