"""Window operators.

Running windows (W3 running count, W4 rank, W5/W6 fills) come in two forms:

* plain: one ``Window.partitionBy(partition)`` — right when a partition is
  bounded by construction (the events of one transaction);
* split (``bucket=`` given): the ordered partition is cut into buckets of the
  order key, the window runs per (partition, bucket) and a per-bucket summary
  carries the running state across bucket edges. A hot key holding a third
  of all rows is then spread over many tasks instead of one, and a
  global (unpartitioned) order no longer funnels into a single task.
  Where no bucket of the order key is bounded by construction, ``rank0`` takes
  ``rows=``: quantile sketches of the keys that are too large give splitters
  (:func:`bounded_buckets`), so every bucket is bounded whatever the data.

Carry tables hold one row per (partition, bucket) — orders of magnitude
smaller than the input — and are joined on the same keys the main window
is already hash-partitioned by, so the big side is shuffled once. The
per-bucket summary is a partial+final aggregate over a second (pruned,
columnar) read of the input: measured cheaper than deriving it from the
windowed rows, which makes Spark sort and run the window twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from ..functions.variant import ColumnOrName, _c

_P, _B, _K = "__part", "__bucket", "__key"


def _names(cols: Sequence[str] | str | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (e.g. newest first).

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most one row per key — a hot
    key does not ship its duplicates. Pass tie-breakers in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The single first row overall (distributed top-1, no global window)."""
    return df.orderBy(*order).limit(1)


def _with_bucket(df: DataFrame, part: list[str], bucket: ColumnOrName) -> DataFrame:
    """Adds the key (partition, bucket) as one struct. A struct is never NULL
    and its NULL fields compare equal, so NULL partition or order keys form
    groups of their own in the windows and in the carry join alike, and both
    still use one hash partitioning."""
    whole = F.struct(*[F.col(c) for c in part]) if part else F.struct(F.lit(0).alias("all"))
    return df.withColumn(_K, F.struct(whole.alias(_P), _c(bucket).alias(_B)))


def _carry_join(local: DataFrame, carry: DataFrame) -> DataFrame:
    return local.join(carry, on=_K, how="left")


def _carry(per_bucket: DataFrame, state: Column, descending: bool = False) -> DataFrame:
    """(key, __carry): ``state`` (an aggregate) over the earlier buckets."""
    b = F.col(f"{_K}.{_B}")
    wc = (Window.partitionBy(F.col(f"{_K}.{_P}")).orderBy(b.desc() if descending else b)
          .rowsBetween(Window.unboundedPreceding, -1))
    return per_bucket.select(_K, state.over(wc).alias("__carry"))


def conditional_true_event(df: DataFrame, cond: Column, partition: Sequence[str] | str | None,
                           order: ColumnOrName, out: str, bucket: ColumnOrName | None = None
                           ) -> DataFrame:
    """W3 CONDITIONAL_TRUE_EVENT: running count of rows where ``cond`` is true,
    in ``order`` within ``partition`` (frame: unbounded preceding → current)."""
    part = _names(partition)
    flag = F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    cols = df.columns
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(_c(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(flag).over(w))
    b = _with_bucket(df, part, bucket).withColumn("__flag", flag)
    wl = Window.partitionBy(_K).orderBy(_c(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("__local", F.sum("__flag").over(wl))
    per_bucket = b.groupBy(_K).agg(F.sum("__flag").alias("__n"))
    j = _carry_join(local, _carry(per_bucket, F.sum("__n")))
    return j.select(*cols, (F.col("__local") + F.coalesce("__carry", F.lit(0))).alias(out))


#: Splitters that one sketch gives, its accuracy (rank error about 0.08 %), and
#: the most that all keys of a level may have together (they are broadcast).
FAN, SKETCH_K, MAX_SPLITTERS = 256, 4096, 1 << 20
LEVELS = 8
_PATH, _V = "__path", "__v"


def _ordinal(df: DataFrame, order: ColumnOrName) -> tuple[Column, str]:
    """The order key as a number in the same order (equal numbers: equal keys)
    and the sketch type for it."""
    o = _c(order)
    kind = df.select(o.alias("o")).schema["o"].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(o.cast("timestamp")), "bigint"
    if isinstance(kind, T.DateType):
        return F.unix_date(o).cast("bigint"), "bigint"
    if isinstance(kind, T.IntegralType):
        return o.cast("bigint"), "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return o.cast("double"), "double"
    raise ValueError(f"no quantile sketch for an order key of type {kind.simpleString()}")


def bounded_buckets(df: DataFrame, partition: Sequence[str] | str | None, order: ColumnOrName,
                    rows: int) -> tuple[DataFrame, bool]:
    """``df`` with its partition as a struct and a bucket path (array of int) such
    that paths sort like the order key, and whether any partition was split.

    A partition of more than ``rows`` rows is cut at quantiles of a sketch of its
    order key, aiming at half of ``rows``; a bucket that is still too large is cut
    again. Even path elements are open ranges between splitters. Odd ones are a
    splitter's own rows: these are ties, so they may be any number, as nothing
    needs them in one task. Paths start with 0, those of NULL order keys are [-1]. Counts and
    sketches are partially aggregated; a level's splitters number at most two per
    ``rows`` rows and ``MAX_SPLITTERS`` in all (``rows`` grows beyond that), and
    are broadcast."""
    from ..sources.sinks import stage
    spark = df.sparkSession
    part = _names(partition)
    whole = F.struct(*[F.col(c) for c in part]) if part else F.struct(F.lit(0).alias("all"))
    v, kind = _ordinal(df, order)
    d = df.withColumn(_P, whole).withColumn(_V, v)
    d = d.withColumn(_PATH, F.when(F.col(_V).isNull(), F.array(F.lit(-1))).otherwise(F.array(F.lit(0))))
    ranks = "array(" + ", ".join(f"{i / FAN!r}D" for i in range(1, FAN)) + ")"
    split = False
    for _ in range(LEVELS):
        open_range = F.element_at(_PATH, -1) % 2 == 0
        counts = d.where(open_range).groupBy(F.struct(_P, _PATH).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        counts = stage(spark, counts.where(F.col("__n") > rows))
        total = counts.agg(F.sum("__n")).first()[0]
        if total is None:
            break
        split = True
        rows = max(rows, -(-2 * total // MAX_SPLITTERS))
        hot = F.broadcast(counts.where(F.col("__n") > rows))
        keyed = d.where(open_range).withColumn("__k", F.struct(_P, _PATH))
        sketch = keyed.join(hot.select("__k"), "__k", "left_semi").groupBy("__k").agg(
            F.expr(f"kll_sketch_agg_{kind}({_V}, {SKETCH_K})").alias("__s"))
        q = F.expr(f"kll_sketch_get_quantile_{kind}(__s, {ranks})")
        step = F.greatest(F.lit(1), F.floor(F.lit(FAN) * rows / (F.col("__n") * 2))).cast("int")
        cuts = sketch.join(hot, "__k").select("__k", q.alias("__q"), step.alias("__step")).select(
            "__k", F.array_distinct(F.filter("__q", lambda x, i: (i + 1) % F.col("__step") == 0)).alias("__cuts"))
        cuts = F.broadcast(stage(spark, cuts))
        below = F.size(F.filter("__cuts", lambda c: c < F.col(_V))).cast("int")
        at = below * 2 + F.array_contains("__cuts", F.col(_V)).cast("int")
        cols = d.columns
        d = (d.withColumn("__k", F.struct(_P, _PATH)).join(cuts, "__k", "left")
             .withColumn(_PATH, F.when(F.col("__cuts").isNull(), F.col(_PATH))
                         .otherwise(F.concat(_PATH, F.array(at)))).select(*cols))
    return d, split


def _rank0_bounded(df: DataFrame, part: list[str], order: ColumnOrName, out: str, rows: int) -> DataFrame:
    cols = df.columns
    d, split = bounded_buckets(df, part, order, rows)
    if not split:
        return rank0(df, part, order, out)
    d = d.withColumn(_K, F.struct(F.col(_P), F.col(_PATH).alias(_B)))
    tie = F.element_at(_PATH, -1) % 2 != 0
    carry = _carry(d.groupBy(_K).agg(F.count(F.lit(1)).alias("__n")), F.sum("__n"))
    rest = F.coalesce("__carry", F.lit(0))
    # NULLs are first; a splitter's rows share the rank that its bucket starts with
    nulls = d.where(F.col(_V).isNull()).select(*cols, F.lit(0).cast("bigint").alias(out))
    starts = F.broadcast(carry.where(F.element_at(F.col(f"{_K}.{_B}"), -1) % 2 == 1))
    ties = d.where(tie & F.col(_V).isNotNull()).join(starts, _K, "left").select(*cols, rest.cast("bigint").alias(out))
    local = d.where(~tie).withColumn("__local", F.rank().over(Window.partitionBy(_K).orderBy(_c(order))))
    open_ = _carry_join(local, carry).select(*cols, (F.col("__local") - 1 + rest).cast("bigint").alias(out))
    return nulls.unionByName(ties).unionByName(open_)


def rank0(df: DataFrame, partition: Sequence[str] | str | None, order: ColumnOrName, out: str,
          bucket: ColumnOrName | None = None, ties: bool = True, rows: int | None = None) -> DataFrame:
    """``RANK() − 1`` within ``partition`` by an ascending order key.
    Ties share a rank; with ``bucket`` derived from the order key, ties never
    straddle a bucket edge, so rank = rank-in-bucket + rows of earlier buckets.
    ``rows`` cuts the partitions that hold more rows at sketched quantiles
    instead, so that no window partition holds more however the rows are spread;
    rows that tie on a splitter need no window and stay where they are.
    ``ties=False`` numbers the rows instead (``ROW_NUMBER() − 1``); ``order``
    may then be several columns, the first of which gives the bucket."""
    part = _names(partition)
    if rows is not None:
        if not ties or bucket is not None:
            raise ValueError("rows= ranks with ties and finds its own buckets")
        return _rank0_bounded(df, part, order, out, rows)
    cols = df.columns
    by = [_c(o) for o in (order if isinstance(order, (list, tuple)) else [order])]
    rank = F.rank if ties else F.row_number
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(*by)
        return df.withColumn(out, (rank().over(w) - 1).cast("bigint"))
    b = _with_bucket(df, part, bucket)
    local = b.withColumn("__local", rank().over(Window.partitionBy(_K).orderBy(*by)))
    per_bucket = b.groupBy(_K).agg(F.count(F.lit(1)).alias("__n"))
    j = _carry_join(local, _carry(per_bucket, F.sum("__n")))
    return j.select(*cols, (F.col("__local") - 1 + F.coalesce("__carry", F.lit(0))).cast("bigint")
                    .alias(out))


def _fill(df: DataFrame, value: Column, partition, order: ColumnOrName, out: str,
          descending: bool, default, bucket) -> DataFrame:
    part = _names(partition)
    cols = df.columns
    o = _c(order)
    o_sorted = o.desc() if descending else o.asc()
    dflt = None if default is None else F.lit(default)
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(o_sorted).rowsBetween(Window.unboundedPreceding, 0)
        res = F.last(value, ignorenulls=True).over(w)
        return df.withColumn(out, res if dflt is None else F.coalesce(res, dflt))
    b = _with_bucket(df, part, bucket).withColumn("__v", value).withColumn("__o", o)
    wl = Window.partitionBy(_K).orderBy(F.col("__o").desc() if descending else F.col("__o"))
    local = b.withColumn("__local", F.last("__v", ignorenulls=True).over(
        wl.rowsBetween(Window.unboundedPreceding, 0)))
    # one summary row per bucket (also buckets without any non-NULL value):
    # the extreme non-NULL value; a struct orders NULL order keys first
    pick = F.min_by if descending else F.max_by
    per_bucket = b.groupBy(_K).agg(
        pick("__v", F.when(F.col("__v").isNotNull(), F.struct("__o"))).alias("__bv"))
    j = _carry_join(local, _carry(per_bucket, F.last("__bv", ignorenulls=True), descending))
    res = F.coalesce(F.col("__local"), F.col("__carry"))
    if dflt is not None:
        res = F.coalesce(res, dflt)
    return j.select(*cols, res.alias(out))


def fill_last(df: DataFrame, value: Column, order: ColumnOrName, out: str,
              partition: Sequence[str] | str | None = None, default=None,
              bucket: ColumnOrName | None = None) -> DataFrame:
    """W6 forward fill: last non-NULL ``value`` at or before the row."""
    return _fill(df, value, partition, order, out, False, default, bucket)


def fill_next(df: DataFrame, value: Column, order: ColumnOrName, out: str,
              partition: Sequence[str] | str | None = None, default=None,
              bucket: ColumnOrName | None = None) -> DataFrame:
    """W5 ``LAST_VALUE(v IGNORE NULLS) OVER (ORDER BY o DESC ROWS UNBOUNDED
    PRECEDING)``: the first non-NULL ``value`` at or after the row."""
    return _fill(df, value, partition, order, out, True, default, bucket)
