"""Bronze views (§2.10): the landed records of one feed, incremental or full."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import choose_scan, explode_response, source_path

FEEDS = ("blocks", "transactions", "tx_count")


def bronze(spark: SparkSession, root: str, feed: str, incremental: bool = True,
           lookback_days: int = 3, now: dt.datetime | None = None,
           explode_key: str | None = None, mark: dt.datetime | None = None) -> DataFrame:
    """``bronze__<feed>`` (incremental: files of the ``lookback_days`` before
    ``now`` and all since ``mark``, the consumer's newest file time)
    or ``bronze__<feed>_fr`` (all files). ``explode_key`` turns page
    responses into one record per element (S7), e.g. ``result.txs``."""
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    df = choose_scan(spark, source_path(root, feed), incremental, lookback_days, now, mark=mark)
    return explode_response(df, explode_key) if explode_key else df
