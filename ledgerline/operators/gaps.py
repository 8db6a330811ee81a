"""Sequence-gap detection (J6/J7/J10/W7) without a range join.

A gap is a run of missing integers between two consecutive present keys.
The previous key (LAG) is computed per bucket of the key space, so no task
sees more than one bucket; only the first row of a bucket looks up the
maximum of the nearest earlier non-empty bucket in a one-row-per-bucket
table. Gaps are emitted as ranges; expanding them to ids is chunked and
re-spread so one huge outage does not become one huge task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 20   # ids per LAG bucket
DEFAULT_CHUNK = 1 << 16          # ids expanded per row


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("k")).where(F.col("k").isNotNull()).distinct()


def with_prev(keys: DataFrame, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """(k, prev_k) for distinct keys ``k``: prev_k = previous present key."""
    kb = keys.withColumn("__b", F.floor(F.col("k") / F.lit(bucket_width)).cast("bigint"))
    local = kb.withColumn("__lp", F.lag("k").over(Window.partitionBy("__b").orderBy("k")))
    edges = kb.groupBy("__b").agg(F.max("k").alias("__bmax"))
    # tiny table (one row per non-empty bucket): a global window is fine here
    carry = edges.select("__b", F.lag("__bmax").over(Window.orderBy("__b")).alias("__carry"))
    j = local.join(carry, "__b", "left")
    return j.select("k", F.coalesce("__lp", "__carry").alias("prev_k"))


def find_gaps(df: DataFrame, key: str, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Missing-id ranges ``(gap_start, gap_end)`` strictly between consecutive
    present values of ``key`` (J6 ``prev < id < cur`` with ``cur − prev ≠ 1``)."""
    p = with_prev(distinct_keys(df, key), bucket_width)
    return (p.where(F.col("k") - F.col("prev_k") > 1)
             .select((F.col("prev_k") + 1).alias("gap_start"), (F.col("k") - 1).alias("gap_end")))


def expand_ranges(ranges: DataFrame, lo: str, hi: str, out: str,
                  chunk: int = DEFAULT_CHUNK, spread: int | None = None) -> DataFrame:
    """Expand inclusive ``[lo, hi]`` ranges to one row per integer (J7/U5
    without recursion). Ranges are first cut into chunks of ``chunk`` ids and
    the chunk rows are spread round-robin before the final explode."""
    n = F.floor((F.col(hi) - F.col(lo)) / F.lit(chunk)).cast("bigint")
    chunks = (ranges.where(F.col(hi) >= F.col(lo))
                    .select(F.col(lo).alias("__lo"), F.col(hi).alias("__hi"),
                            F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("__c"))
                    .select((F.col("__lo") + F.col("__c") * chunk).alias("__a"), "__hi"))
    chunks = chunks.select("__a", F.least(F.col("__hi"), F.col("__a") + (chunk - 1)).alias("__z"))
    if spread is None:
        spread = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(spread)
    return chunks.select(F.explode(F.sequence("__a", "__z")).alias(out))


def missing_ids(df: DataFrame, key: str, out: str = "missing_id",
                bucket_width: int = DEFAULT_BUCKET_WIDTH, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Every integer missing between the min and max present ``key``."""
    return expand_ranges(find_gaps(df, key, bucket_width), "gap_start", "gap_end", out, chunk)


def to_ranges(ids: DataFrame, key: str, bucket_width: int = DEFAULT_BUCKET_WIDTH,
              lo: str = "range_start", hi: str = "range_end") -> DataFrame:
    """Maximal runs of consecutive integers (inclusive ``lo``, ``hi``): the
    run-length form of a set of ids. Runs are found per bucket of the key space
    (a run keeps id − position constant); only the at most two runs of a bucket
    that touch its edges can go on in a neighbour, and those few are joined."""
    k = distinct_keys(ids, key).withColumn("__b", F.floor(F.col("k") / F.lit(bucket_width)).cast("bigint"))
    w = Window.partitionBy("__b").orderBy("k")
    runs = (k.withColumn("__r", F.col("k") - F.row_number().over(w)).groupBy("__b", "__r")
            .agg(F.min("k").alias(lo), F.max("k").alias(hi)))
    edge = (F.pmod(F.col(lo), F.lit(bucket_width)) == 0) | (F.pmod(F.col(hi) + 1, F.lit(bucket_width)) == 0)
    every = Window.orderBy(lo)                       # two rows per non-empty bucket at most
    start = F.when(F.lag(hi).over(every) == F.col(lo) - 1, 0).otherwise(1)
    linked = (runs.where(edge).select(lo, hi, start.alias("__s"))
              .withColumn("__g", F.sum("__s").over(every.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("__g").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)))
    return runs.where(~edge).select(lo, hi).unionByName(linked.select(lo, hi))
