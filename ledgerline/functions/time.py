"""Time helpers. Every 'now' is injected by the caller (one value per run)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import ColumnOrName, _c

# Fixed value: the landing-file timestamp mask of transaction requests
# (year_month_day_hour24_minute_second_millis).
BLOCK_TS_FORMAT = "yyyy_MM_dd_HH_mm_ss_SSS"


def ts_lit(ts: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    if isinstance(ts, str):
        ts = dt.datetime.fromisoformat(ts)
    return F.lit(ts.replace(tzinfo=None)).cast("timestamp_ntz")


def hour_floor(col: ColumnOrName) -> Column:
    """DATE_TRUNC('hour') kept as TIMESTAMP_NTZ."""
    return F.date_trunc("hour", _c(col)).cast("timestamp_ntz")


def closed_hour_cond(col: ColumnOrName, now) -> Column:
    """Complete-period predicate (P14): hour strictly before the current hour."""
    return hour_floor(col) < hour_floor(ts_lit(now))


def settled_cond(col: ColumnOrName, now, hours: int = 12) -> Column:
    """Settled-data predicate (P15): ts ≤ now − hours."""
    return _c(col) <= ts_lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")


def parse_block_ts(col: ColumnOrName) -> Column:
    """TO_TIMESTAMP_NTZ(s, 'YYYY_MM_DD_HH_MI_SS_FF3') (F21); NULL if malformed."""
    return F.try_to_timestamp(_c(col), F.lit(BLOCK_TS_FORMAT)).cast("timestamp_ntz")


def format_block_ts(col: ColumnOrName) -> Column:
    """TO_CHAR(ts, same mask) (F22) — inverse of :func:`parse_block_ts` at ms."""
    return F.date_format(_c(col), BLOCK_TS_FORMAT)
