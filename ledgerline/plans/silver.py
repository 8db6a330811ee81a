"""Silver layer: parsed, deduplicated, grouped chain records (§2.10).

All steps are native expressions over VARIANT payloads; arrays are
flattened with ``posexplode`` (inner semantics: empty/NULL drops the row).
A transaction's events and log entries stay in its row (their number is
bounded by the block gas limit) until they are grouped: the transactions are
shuffled and sorted, their many events are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_ci, decode_or_keep, surrogate_key, try_base64_decode
from ..functions.time import parse_block_ts
from ..functions.variant import (no_error, not_empty_array, parse_or_text, vget,
                                 vget_first, vsize, vstring)
from ..operators.incremental import with_audit
from ..operators.windows import latest_by_key

HEADER_PATHS = ("result.block.header", "block.header")


def _hdr(field: str) -> list[str]:
    return [f"{p}.{field}" for p in HEADER_PATHS]


def _audit(df: DataFrame, run_ts, run_id) -> DataFrame:
    return df if run_ts is None else with_audit(df, run_ts, run_id or "")


# ------------------------------------------------------------------ blocks
def silver_blocks(bronze: DataFrame, blockchain: str = "cosmos", run_ts=None,
                  run_id: str | None = None) -> DataFrame:
    """Parse block responses of both shapes, drop error records and rows
    without a block id, keep the newest landing per (chain_id, block_id)."""
    d, v = F.col("data"), F.col("value")
    ts_paths = _hdr("time") + _hdr("timestamp")
    df = bronze.where(no_error("data", "value")).select(
        F.lit(blockchain).alias("blockchain"),
        vget_first(v, ["BLOCK_ID", "block_id"], "bigint").alias("block_id"),
        vget_first(d, ts_paths, "timestamp_ntz").alias("block_timestamp"),
        vget_first(d, _hdr("chain_id")).alias("chain_id"),
        F.coalesce(vsize(d, "result.block.data.txs"), vsize(d, "block.data.txs"))
         .cast("bigint").alias("tx_count"),
        vget_first(d, _hdr("proposer_address")).alias("proposer_address"),
        vget_first(d, _hdr("validators_hash")).alias("validator_hash"),
        vget_first(d, list(HEADER_PATHS), "variant").alias("header"),
        F.col("inserted_timestamp").alias("_inserted_timestamp"),
    ).where(F.col("block_id").isNotNull())
    df = latest_by_key(df, ["chain_id", "block_id"], [F.col("_inserted_timestamp").desc()])
    df = df.withColumn("blocks_id", surrogate_key("chain_id", "block_id"))
    return _audit(df, run_ts, run_id)


# ------------------------------------------------------------ transactions
def silver_transactions(bronze: DataFrame, run_ts=None, run_id: str | None = None,
                        keep_data: bool = True) -> DataFrame:
    """One row per (block_id, tx_id), newest landing wins; empty pages dropped.
    ``keep_data=False`` leaves the raw response out: the dedupe shuffle then
    carries only typed columns plus ``msgs``/``tx_log``, and the table does
    not duplicate bronze (messages and logs need nothing else)."""
    d, v = F.col("data"), F.col("value")
    code = vget(d, "tx_result.code", "bigint")
    df = bronze.where(not_empty_array("data")).select(
        vget(v, "BLOCK_ID_REQUESTED", "bigint").alias("block_id"),
        parse_block_ts(vget(v, "BLOCK_TIMESTAMP")).alias("block_timestamp"),
        vget(d, "hash").alias("tx_id"),
        vget(d, "index", "bigint").alias("tx_index"),
        vget(d, "tx_result.codespace").alias("codespace"),
        vget(d, "tx_result.gas_used", "bigint").alias("gas_used"),
        vget(d, "tx_result.gas_wanted", "bigint").alias("gas_wanted"),
        F.coalesce(code == 0, F.lit(False)).alias("tx_succeeded"),
        code.cast("int").alias("tx_code"),
        parse_or_text(vget(d, "tx_result.log")).alias("tx_log"),
        vget(d, "tx_result.events", "variant").alias("msgs"),
        *([d.alias("data")] if keep_data else []),
        F.col("partition_key"),
        F.col("inserted_timestamp").alias("_inserted_timestamp"))
    df = latest_by_key(df, ["block_id", "tx_id"], [F.col("_inserted_timestamp").desc()])
    df = df.withColumn("transactions_id", surrogate_key("block_id", "tx_id"))
    return _audit(df, run_ts, run_id)


# -------------------------------------------------------------------- msgs
TX_COLS = ["block_id", "block_timestamp", "tx_id", "tx_succeeded"]
# Message windows are keyed by (block_id, tx_id): the transaction dedupe has
# already hash-partitioned the rows on exactly these keys, so flattening and
# all message windows run without another shuffle of the (many) event rows.
# A valid chain never has one hash in two blocks; if it did, keying by block
# keeps their events apart instead of interleaving two msg_index sequences.
TX_KEY = ["block_id", "tx_id"]


def flatten_events(txs: DataFrame) -> DataFrame:
    """One row per event of ``msgs`` with its 0-based index."""
    return txs.select(*TX_COLS, "_inserted_timestamp",
                      F.posexplode(F.try_variant_get("msgs", "$", "array<variant>"))
                       .alias("msg_index", "msg"))


#: What an event is to the grouping.
OTHER, ACTION, EXEC, MARKER = 0, 1, 2, 3


def _event_kind(type_, k0, dk, v0, strict_compat: bool = False):
    """An event's kind, by its type and its first attribute: the key ``k0`` (``dk``:
    decoded, if it is base64) and the value."""
    key = F.coalesce(dk, k0)
    value = F.when(dk.isNull(), k0 if strict_compat else v0).otherwise(try_base64_decode(v0))
    message = type_ == "message"
    return (F.when(key == "action", F.when(message & contains_ci(value, "exec"), F.lit(EXEC)).otherwise(F.lit(ACTION)))
            .when((key == "module") & message, F.lit(MARKER)).otherwise(F.lit(OTHER)))


def _event_kinds(msgs, strict_compat: bool = False):
    """The kinds of an array of events. Lambdas are interpreted and compute again
    what they name twice, so each step keeps what the next one reads."""
    read = F.transform(msgs, lambda m: F.struct(vget(m, "type").alias("t"), vget(m, "attributes[0].key").alias("k"),
                                                vget(m, "attributes[0].value").alias("v")))
    known = F.transform(read, lambda e: F.struct(e["t"].alias("t"), e["k"].alias("k"), e["v"].alias("v"),
                                                 try_base64_decode(e["k"]).alias("d")))
    return F.transform(known, lambda e: _event_kind(e["t"], e["k"], e["d"], e["v"], strict_compat))


def _let(value, use):
    """``use(value)`` with the value computed once however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _where(codes, test):
    """0-based positions of the codes that pass."""
    return F.array_compact(F.transform(codes, lambda c, i: F.when(test(c), i)))


def _runs(starts, end, part):
    """``part(start, length, number)`` of each run, given their 0-based starts;
    each run ends where the next one starts, the last at ``end``."""
    return _let(starts, lambda s: F.transform(s, lambda at, n: part(
        at, F.coalesce(F.get(s, n + 1), end) - at, n)))


def _sub_groups(codes):
    """Sub-groups of an exec group's events, given their kinds: the number of the
    next marker at or after each, 0 past the last one."""
    def numbered(marks):
        upto = F.transform(marks, lambda at, n: F.array_repeat(
            n.cast("bigint"), at - F.coalesce(F.get(marks, n - 1), F.lit(-1))))
        last = F.coalesce(F.get(marks, F.size(marks) - 1), F.lit(-1))
        return F.concat(F.flatten(upto), F.array_repeat(F.lit(0).cast("bigint"), F.size(codes) - 1 - last))
    return _let(_where(codes, lambda c: c == MARKER), numbered)


def event_groups(kinds):
    """X1 inside a row: (msg_group, msg_sub_group) of each of a transaction's
    events, given the array of their kinds; as :func:`msg_groups`. The array is cut
    at the actions and the groups at their markers, so time is linear."""
    def pair(group, sub):
        return F.struct(group.cast("bigint").alias("g"), sub.cast("bigint").alias("s"))

    def group(codes, at, length, n):
        # an empty slice cannot be: a run holds its action
        return _let(F.slice(codes, at + 1, length), lambda own: F.when(
            own[0] == EXEC, F.transform(_sub_groups(own), lambda s: pair(n, s)))
            .otherwise(F.transform(own, lambda _: pair(n, F.lit(0)))))

    def grouped(codes):
        def cut(starts):
            none = F.array_repeat(pair(F.lit(None), F.lit(None)), F.coalesce(F.get(starts, F.lit(0)), F.size(codes)))
            return F.concat(none, F.flatten(_runs(starts, F.size(codes), lambda at, length, n: group(codes, at, length, n))))
        return _let(_where(codes, lambda c: (c == ACTION) | (c == EXEC)), cut)
    return _let(kinds, grouped)


def msg_groups(events: DataFrame, strict_compat: bool = False) -> DataFrame:
    """X1 message grouping of exploded events in window passes that look back
    only; :func:`silver_msgs` groups a transaction's events inside its row.

    ``msg_group``: running count of *action* events (first attribute key is
    ``action``, base64 or plain) minus one, NULL before the first action (W3).
    ``msg_sub_group``: inside groups whose action contains ``exec``, the
    ``module`` message events are markers numbered 0, 1, …; every event takes
    the number of the next marker at or after it (0 when none); NULL when the
    group is NULL. ``strict_compat`` reproduces the original rule that reads
    a plain-text key in place of the value (D7).

    Every group starts at its action event, so the group-level quantities of
    the original (exec flag per group, RANK of markers, look-ahead fill) are
    read off transaction-level running values: the exec flag is the latest
    action's; markers before a row in its group = running module count minus
    the count at the group's start; the group's marker total = the greatest
    count among its rows. The next marker at or after a row is numbered by the
    markers before it, if the group has more. All passes keep the (block_id,
    tx_id) partitioning, so the event rows are shuffled once (by the upstream
    dedupe); time is linear in a transaction's events but for the sorts."""
    k0 = vget("msg", "attributes[0].key")
    kind = _event_kind(vget("msg", "type"), k0, try_base64_decode(k0), vget("msg", "attributes[0].value"), strict_compat)
    ev = events.select("*", vget("msg", "type").alias("msg_type"), kind.alias("__kind"))
    ev = ev.select("*", F.col("__kind").isin(ACTION, EXEC).alias("__act"), (F.col("__kind") == EXEC)
                   .cast("int").alias("__xr"), (F.col("__kind") == MARKER).cast("bigint").alias("__mm"))
    w = Window.partitionBy(*TX_KEY).orderBy("msg_index")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # pass 1: running action count, running module count, latest action's flag
    ev = ev.select("*",
                   F.sum(F.col("__act").cast("bigint")).over(upto).alias("__cte"),
                   F.sum("__mm").over(upto).alias("__r"),
                   F.last(F.when(F.col("__act"), F.col("__xr")), ignorenulls=True).over(upto)
                    .alias("__ex"))
    # pass 2 (same spec, no new sort): module count at this group's start and
    # at the next group's start (= this group's end)
    ev = ev.select("*",
                   F.last(F.when(F.col("__act"), F.col("__r")), ignorenulls=True).over(upto)
                    .alias("__base"))
    # pass 3: the module count at the group's end, over the group's own rows (a
    # frame that looks ahead would be walked again for every row)
    ev = ev.select("*", F.max("__r").over(Window.partitionBy(*TX_KEY, "__cte")).alias("__end"))
    group = F.nullif(F.col("__cte") - 1, F.lit(-1)).cast("bigint")
    before = F.col("__r") - F.col("__mm") - F.col("__base")
    total = F.col("__end") - F.col("__base")
    sub = F.when((F.col("__ex") == 1) & (total > before), before).otherwise(F.lit(0))
    return ev.withColumn("msg_group", group).withColumn(
        "msg_sub_group", F.when(F.col("msg_group").isNotNull(), sub).cast("bigint"))


def silver_msgs(txs: DataFrame, strict_compat: bool = False, run_ts=None,
                run_id: str | None = None, partition_input: bool = False) -> DataFrame:
    """Messages of each transaction with their groups, found before the events are
    flattened (:func:`event_groups`), so that no event is shuffled or sorted.
    ``partition_input``: spread a stored transactions table by (block_id, tx_id)
    first."""
    if partition_input:
        txs = txs.repartition(*TX_KEY)
    t = txs.select(*TX_COLS, "_inserted_timestamp", F.try_variant_get("msgs", "$", "array<variant>").alias("__msgs"))
    kinds = _event_kinds("__msgs", strict_compat)
    g = t.select(*TX_COLS, "_inserted_timestamp", F.posexplode(F.arrays_zip("__msgs", event_groups(kinds).alias("__at")))
                 .alias("msg_index", "__e"))
    g = g.select(*TX_COLS, "msg_index", F.col("__e")["__msgs"].alias("msg"), F.col("__e")["__at"].alias("__at"),
                 "_inserted_timestamp")
    out = g.select(*TX_COLS, F.col("__at.g").alias("msg_group"), F.col("__at.s").alias("msg_sub_group"),
                   F.col("msg_index").cast("int"), vget("msg", "type").alias("msg_type"), "msg",
                   surrogate_key("tx_id", "msg_index").alias("msgs_id"), "_inserted_timestamp")
    return _audit(out, run_ts, run_id)


# -------------------------------------------------------------- attributes
MSG_COLS = TX_COLS + ["msg_group", "msg_sub_group", "msg_index", "msg_type"]


def silver_msg_attributes(msgs: DataFrame, run_ts=None, run_id: str | None = None
                          ) -> DataFrame:
    """One row per attribute of each message, decode-or-keep."""
    a = msgs.select(*MSG_COLS, "_inserted_timestamp",
                    F.posexplode(F.try_variant_get("msg", "$.attributes", "array<variant>"))
                     .alias("attribute_index", "__a"))
    k, v = decode_or_keep(vget("__a", "key"), vget("__a", "value"))
    out = a.select(*MSG_COLS, F.col("attribute_index").cast("int"), k.alias("attribute_key"),
                   v.alias("attribute_value"),
                   surrogate_key("tx_id", "msg_index", "attribute_index")
                   .alias("msg_attributes_id"), "_inserted_timestamp")
    return _audit(out, run_ts, run_id)


# -------------------------------------------------------------------- logs
LOG_TX_COLS = ["block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_code", "codespace",
               "_inserted_timestamp"]


def normalize_logs(txs: DataFrame, accept_arrays: bool = False, run_ts=None,
                   run_id: str | None = None, partition_input: bool = False) -> DataFrame:
    """Per transaction, an ordered array of events
    ``{msg_index, event_type, attributes[{key, value}]}``.

    Succeeded txs with an object-shaped log: entries → events → attributes,
    regrouped by (msg_index, event_type) with a missing msg_index read as 0
    and a missing value as ''; attributes keep their position order, events
    are ordered by (msg_index, event_type); empty/NULL arrays at any level
    drop out (inner flatten), and a tx left with no event is dropped. Failed
    txs with a log get one synthetic ``error`` event holding the raw text.
    Newest landing per tx.

    Every log is normalised inside its transaction's row: its attributes are
    listed, sorted once by (msg_index, event_type, position) and cut into events,
    so only whole transactions are shuffled, for the newest landing of each.
    ``partition_input`` spreads a stored table by (block_id, tx_id) first."""
    base = txs.where(F.col("tx_log").isNotNull())
    if partition_input:
        base = base.repartition(*TX_KEY)
    ok = F.col("tx_succeeded")
    as_map = F.when(ok, F.try_variant_get("tx_log", "$", "map<string,variant>"))
    entries = F.transform(F.map_entries(as_map),
                          lambda e: F.struct(F.coalesce(e["key"].try_cast("int"), F.lit(0))
                                              .alias("pos"), e["value"].alias("entry")))
    if accept_arrays:
        as_arr = F.when(ok, F.try_variant_get("tx_log", "$", "array<variant>"))
        entries = F.coalesce(entries, F.transform(
            as_arr, lambda x, i: F.struct(i.alias("pos"), x.alias("entry"))))
    array = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array())

    def attributes(e):
        mi = F.coalesce(vget(e["entry"], "msg_index", "int"), F.lit(0))
        return F.flatten(F.transform(array(e["entry"], "$.events"), lambda ev, vpos: F.transform(
            array(ev, "$.attributes"), lambda a, apos: F.when(a.isNotNull(), F.struct(
                mi.alias("msg_index"), vget(ev, "type").alias("event_type"), e["pos"].alias("s0"), vpos.alias("s1"),
                apos.alias("s2"), vget(a, "key").alias("key"), F.coalesce(vget(a, "value"), F.lit("")).alias("value"))))))

    def events(rows):
        def begins(x, i):
            b = F.get(rows, i - 1)
            return (i == 0) | (b["msg_index"] != x["msg_index"]) | ~b["event_type"].eqNullSafe(x["event_type"])
        starts = F.array_compact(F.transform(rows, lambda x, i: F.when(begins(x, i), i)))
        return _runs(starts, F.size(rows), lambda at, length, _: F.struct(
            F.get(rows, at)["msg_index"].alias("msg_index"), F.get(rows, at)["event_type"].alias("event_type"),
            F.transform(F.slice(rows, at + 1, length), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
             .alias("attributes")))
    found = F.sort_array(F.array_compact(F.flatten(F.transform(entries, attributes))))
    failed_log = F.array(F.struct(
        F.lit(0).alias("msg_index"), F.lit("error").alias("event_type"),
        F.array(F.struct(F.lit("error_message").alias("key"),
                         vstring("tx_log").alias("value"))).alias("attributes")))
    both = base.select(*LOG_TX_COLS, F.when(~ok, failed_log).otherwise(_let(found, events)).alias("tx_log"))
    both = both.where(F.size("tx_log") > 0)
    out = latest_by_key(both, ["tx_id"], [F.col("_inserted_timestamp").desc(),
                                          F.col("block_id").desc()])
    out = out.select("block_id", "block_timestamp", "tx_id", "tx_succeeded", "tx_code",
                     "codespace", "tx_log", surrogate_key("tx_id").alias("transactions_logs_id"),
                     "_inserted_timestamp")
    return _audit(out, run_ts, run_id)


# the blueprint's model name for the log normalisation
silver_transactions_logs = normalize_logs
