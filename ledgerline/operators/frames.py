"""Row-level DataFrame operators named after the blueprint: record filters
(P7, P8, P14, P15), lateral flatten (J9/F8) and per-key counts (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import closed_hour_cond, settled_cond
from ..functions.variant import ColumnOrName, _c, no_error, not_empty_array, vget


def drop_errors(df: DataFrame, data: str = "data", value: str = "value") -> DataFrame:
    """Keep responses without an ``error`` (explicit JSON null counts)."""
    return df.where(no_error(data, value))


def drop_empty(df: DataFrame, data: str = "data") -> DataFrame:
    """Drop ``[]`` (and NULL) payloads."""
    return df.where(not_empty_array(data))


def closed_hours(df: DataFrame, col: str, now) -> DataFrame:
    """Rows whose hour is strictly before the current hour."""
    return df.where(closed_hour_cond(col, now))


def settled(df: DataFrame, col: str, now, hours: int = 12) -> DataFrame:
    """Rows at least ``hours`` old."""
    return df.where(settled_cond(col, now, hours))


def flatten(df: DataFrame, col: ColumnOrName, path: str | None = None, outer: bool = False,
            prefix: str = "") -> DataFrame:
    """J9 LATERAL FLATTEN of a VARIANT: one row per array element (``index``
    0-based, ``key`` NULL) or per object field (``key``, ``index`` NULL),
    with ``value`` as VARIANT. Inner by default: an empty/NULL/scalar input
    drops the row; ``outer=True`` keeps it with NULLs."""
    v = vget(col, path, "variant") if path else _c(col)
    arr = F.try_variant_get(v, "$", "array<variant>")
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    t = "struct<index:int,key:string,value:variant>"
    entries = F.coalesce(
        F.transform(arr, lambda x, i: F.struct(i.alias("index"), F.lit(None).cast("string")
                                                .alias("key"), x.alias("value"))),
        F.transform(F.map_entries(obj), lambda e: F.struct(
            F.lit(None).cast("int").alias("index"), e["key"].alias("key"),
            e["value"].alias("value"))))
    gen = F.explode_outer if outer else F.explode
    out = df.select("*", gen(entries.cast(f"array<{t}>")).alias("__f"))
    return out.select(*df.columns, *[F.col(f"__f.{c}").alias(prefix + c)
                                     for c in ("index", "key", "value")])


def count_by_key(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """A2 COUNT per key (partial + final aggregate)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).cast("bigint").alias(out))
