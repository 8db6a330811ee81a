"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import ColumnOrName, _c


def summary_stats(df: DataFrame, key: str, ts: str | None = None) -> DataFrame:
    """A1: one row ``min_key, max_key, [min_ts, max_ts,] n`` (partial agg)."""
    aggs = [F.min(key).alias("min_key"), F.max(key).alias("max_key")]
    if ts:
        aggs += [F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")]
    aggs.append(F.count(F.lit(1)).alias("n"))
    return df.agg(*aggs)


def ordered_array_agg(value: ColumnOrName) -> Column:
    """A8 ARRAY_AGG(x) WITHIN GROUP (ORDER BY x): NULLs skipped, empty → []."""
    return F.coalesce(F.sort_array(F.collect_list(_c(value))), F.array())


def ordered_array_by_group(df: DataFrame, group: Sequence[str], value: str, out: str,
                           chunk: int = 1 << 14) -> DataFrame:
    """A8 per group, two-level for large groups: values are first collected
    and sorted per (group, value chunk) — partial aggregation, many tasks —
    then each group concatenates its few pre-sorted chunks in chunk order,
    so no task sorts a whole hot group. Integral values only; NULLs skipped,
    a group with only NULLs gets ``[]``. With no ``group`` it returns one row
    (``[]`` on empty input)."""
    group = list(group)
    v = F.col(value)
    per_chunk = (df.select(*group, v.alias("__v"))
                   .groupBy(*group, F.expr(f"(__v - pmod(__v, {int(chunk)})) div {int(chunk)}").alias("__c"))
                   .agg(F.sort_array(F.collect_list("__v")).alias("__ids")))
    arr = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__c", "__ids"))),
                                lambda s: s["__ids"]))
    empty = F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")
    if group:
        return per_chunk.groupBy(*group).agg(F.coalesce(arr, empty).alias(out))
    return per_chunk.agg(F.coalesce(arr, empty).alias(out))


def scalar(df: DataFrame, expr: Column):
    """One scalar (high-water mark, bound) — a single-row action."""
    return df.agg(expr.alias("v")).first()["v"]


def least_skip_null(*vals):
    """A14 MIN over a UNION of scalar candidates (NULLs skipped)."""
    vs = [v for v in vals if v is not None]
    return min(vs) if vs else None
