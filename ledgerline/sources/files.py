"""Landed-file scans.

Bronze records are JSON lines ``{"value": …, "data": …}`` under a root
folder. Both scans read them as VARIANT (``singleVariantColumn``) and take
file name and modification time from the hidden ``_metadata`` column, which
replaces a separate file registry join; the incremental scan prunes whole
files by modification time before reading them (``modifiedAfter``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import partition_key_from_path
from ..functions.variant import vget

RECORD = "__rec"


def _records(reader, path, segment: int) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    raw = reader.option("singleVariantColumn", RECORD).json(paths)
    return raw.select(
        F.try_variant_get(RECORD, "$.value", "variant").alias("value"),
        F.try_variant_get(RECORD, "$.data", "variant").alias("data"),
        partition_key_from_path(F.col("_metadata.file_path"), segment).alias("partition_key"),
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz")
         .alias("inserted_timestamp"))


def parsed_once(df: DataFrame, cols: tuple[str, ...] = ("value", "data")) -> DataFrame:
    """The same rows, with these computed columns made once a row: a filter on them
    would be pushed below them, and compute them again for each of its parts."""
    return df.select(*[c for c in df.columns if c not in cols], F.inline(F.array(F.struct(*cols)))).select(*df.columns)


def scan_all(spark: SparkSession, path: str | list[str], segment: int = -1) -> DataFrame:
    """S2 full-refresh scan of every landed file under one or more folders."""
    return _records(spark.read.option("recursiveFileLookup", "true"), path, segment)


def scan_recent(spark: SparkSession, path: str | list[str], days: int, now, segment: int = -1
                ) -> DataFrame:
    """S1 incremental scan: only files modified in the last ``abs(days)`` days."""
    n = dt.datetime.fromisoformat(now) if isinstance(now, str) else now
    return scan_since(spark, path, n - dt.timedelta(days=abs(days)), segment)


def scan_since(spark: SparkSession, path: str | list[str], mark: dt.datetime, segment: int = -1
               ) -> DataFrame:
    """Files modified at/after ``mark`` (a second earlier, as the option is
    exclusive and in whole seconds; callers filter on the file time itself)."""
    after = (mark - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    reader = spark.read.option("recursiveFileLookup", "true").option("modifiedAfter", after)
    return _records(reader, path, segment)


def choose_scan(spark: SparkSession, path: str, is_incremental: bool, days: int = 3,
                now=None, segment: int = -1, mark: dt.datetime | None = None) -> DataFrame:
    """The incremental view when the target exists, else the full scan.
    ``mark`` (the target's newest file time) widens the lookback to all files
    since, so nothing is lost after a long pause; ``now`` is the run's time."""
    if not is_incremental:
        return scan_all(spark, path, segment)
    if now is None and mark is None:
        raise ValueError("an incremental scan needs the run's time or the target's mark")
    if now is None:
        return scan_since(spark, path, mark, segment)
    n = dt.datetime.fromisoformat(now) if isinstance(now, str) else now
    start = n - dt.timedelta(days=abs(days))
    return scan_since(spark, path, start if mark is None else min(start, mark), segment)


def explode_response(df: DataFrame, key: str = "result.txs") -> DataFrame:
    """A page response's array at ``key`` becomes one row per element."""
    others = [c for c in df.columns if c != "data"]
    return df.select(*others, F.explode(F.try_variant_get(vget("data", key, "variant"), "$",
                                                          "array<variant>")).alias("data"))


def number_sequence(spark: SparkSession, lo: int, hi: int, name: str = "_id") -> DataFrame:
    """Dense integers ``lo … hi`` generated in parallel (``spark.range``)."""
    return spark.range(int(lo), int(hi) + 1).select(F.col("id").alias(name))


# S11 declared sources: name → (relative path, record feed)
SOURCES = {
    "blocks": "blocks",
    "tx_count": "tx_count",
    "transactions": "transactions",
    "hourly_prices": "prices",
}


def source_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{SOURCES[name]}"
