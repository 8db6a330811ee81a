"""Join-shaped operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import ColumnOrName, _c


def count_mismatch(expected: DataFrame, actual_rows: DataFrame, key: str, expected_col: str,
                   out: str = "actual_count") -> DataFrame:
    """J5+A2: keys whose declared count differs from the number of rows seen
    (absent = 0). The per-key count is partially aggregated map-side; both
    sides then meet hash-partitioned on ``key``."""
    actual = actual_rows.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(out))
    return (expected.join(actual, key, "left")
                    .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("bigint"))
                    .where(F.col(out) != F.col(expected_col)))


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J11/U3/U4 EXCEPT DISTINCT on ``keys``: wanted − done (NULL-safe)."""
    keys = list(keys)
    return wanted.select(*keys).subtract(done.select(*keys))


def paginate(df: DataFrame, count_col: str, page_size: int = 100, out: str = "page_number"
             ) -> DataFrame:
    """One row per page ``1 … ceil(count / page_size)``; rows with a
    non-positive count produce no page (guards ``sequence(1, 0)``)."""
    pages = F.ceil(F.col(count_col) / F.lit(page_size)).cast("bigint")
    return (df.where(F.col(count_col) > 0)
              .withColumn(out, F.explode(F.sequence(F.lit(1).cast("bigint"), pages))))


def join_file_meta(records: DataFrame, meta: DataFrame, keys: Sequence[str] = ("file_name",
                                                                              "partition_key")
                   ) -> DataFrame:
    """Records ⋈ an explicit file registry, one row per file. Both sides are
    shuffled and the registry is hashed a part at a time: by the sizes of packed
    files Spark would take the records for small and send them all to the driver."""
    return records.join(meta.hint("shuffle_hash"), list(keys), "inner")
