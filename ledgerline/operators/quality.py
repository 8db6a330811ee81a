"""Data-quality checks (Q1–Q8). Every check is one distributed aggregate
returning rows ``(check, tbl, col, failures, threshold, status)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_lit

RESULT_COLS = ["check_name", "tbl", "col", "failures", "threshold", "status"]


def _result(df: DataFrame, check: str, table: str, column: str, failures: Column,
            threshold: int = 0, severity: str = "error") -> DataFrame:
    f = failures.cast("bigint")
    return df.agg(f.alias("failures")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("tbl"), F.lit(column).alias("col"),
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        F.lit(threshold).cast("bigint").alias("threshold"),
        F.when(F.coalesce("failures", F.lit(0)) > threshold, F.lit(severity))
         .otherwise(F.lit("pass")).alias("status"))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Q1 for many columns in one scan: one aggregate, one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = agg.selectExpr(f"stack({len(columns)}, {stack}) as (col, failures)")
    return long.select(F.lit("not_null").alias("check_name"), F.lit(table).alias("tbl"), "col",
                       F.col("failures").cast("bigint").alias("failures"),
                       F.lit(0).cast("bigint").alias("threshold"),
                       F.when(F.col("failures") > 0, F.lit("error")).otherwise(F.lit("pass"))
                        .alias("status"))


def row_checks(df: DataFrame, table: str, not_null_cols: Sequence[str] = (),
               expressions: Sequence[str] = ()) -> DataFrame:
    """Q1 + Q2 fused: every not-null column and every boolean expression of a
    table counted in one aggregate (one scan), then unpivoted to rows."""
    items = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null_cols]
    items += [("expression_is_true", e, F.count_if(~F.coalesce(F.expr(e), F.lit(False))))
              for e in expressions]
    agg = df.agg(*[x.alias(f"__c{i}") for i, (_, _, x) in enumerate(items)])
    stack = ", ".join(f"'{k}', '{c.replace(chr(39), chr(39) * 2)}', `__c{i}`"
                      for i, (k, c, _) in enumerate(items))
    long = agg.selectExpr(f"stack({len(items)}, {stack}) as (check_name, col, failures)")
    return long.select("check_name", F.lit(table).alias("tbl"), "col",
                       F.col("failures").cast("bigint").alias("failures"),
                       F.lit(0).cast("bigint").alias("threshold"),
                       F.when(F.col("failures") > 0, F.lit("error")).otherwise(F.lit("pass"))
                        .alias("status"))


def expression_is_true(df: DataFrame, table: str, expr: str) -> DataFrame:
    """Q2: rows where ``expr`` is not true."""
    return _result(df, "expression_is_true", table, expr, F.count_if(~F.coalesce(F.expr(expr),
                                                                               F.lit(False))))


def sequential_values(df: DataFrame, table: str, column: str, interval: int = 1,
                      threshold: int = 100, bucket_width: int = 1 << 20) -> DataFrame:
    """Q3: number of breaks where a distinct value does not follow its
    predecessor by ``interval`` (bucketed LAG, no single-task window)."""
    from .gaps import distinct_keys, with_prev
    p = with_prev(distinct_keys(df, column), bucket_width)
    return _result(p, "sequential_values", table, column,
                   F.count_if(F.col("prev_k").isNotNull()
                              & (F.col("k") - F.col("prev_k") != interval)), threshold)


def recency(df: DataFrame, table: str, column: str, now, hours: int = 3,
            severity: str = "error") -> DataFrame:
    """Q4: fails (1) when ``max(column)`` is older than ``now − hours``."""
    bound = ts_lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")
    m = F.max(column)
    return _result(df, "recency", table, column,
                   F.when(m.isNull() | (m < bound), F.lit(1)).otherwise(F.lit(0)),
                   severity=severity)


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence,
                    severity: str = "error") -> DataFrame:
    """Q5: non-NULL values outside the accepted set."""
    c = F.col(column)
    return _result(df, "accepted_values", table, column,
                   F.count_if(c.isNotNull() & ~c.isin(list(values))), severity=severity)


def source_freshness(df: DataFrame, table: str, column: str, now, warn_hours: int = 2,
                     error_hours: int = 4) -> DataFrame:
    """Q6: age of the newest record → pass / warn / error."""
    age_h = (F.unix_timestamp(ts_lit(now).cast("timestamp"))
             - F.unix_timestamp(F.max(column).cast("timestamp"))) / 3600.0
    agg = df.agg(age_h.alias("age"))
    return agg.select(
        F.lit("source_freshness").alias("check_name"), F.lit(table).alias("tbl"),
        F.lit(column).alias("col"),
        F.when(F.col("age").isNull() | (F.col("age") > warn_hours), F.lit(1)).otherwise(F.lit(0))
         .cast("bigint").alias("failures"),
        F.lit(warn_hours).cast("bigint").alias("threshold"),
        F.when(F.col("age").isNull() | (F.col("age") > error_hours), F.lit("error"))
         .when(F.col("age") > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Q7: number of key values occurring more than once (partial agg)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _result(dup, "unique", table, ",".join(keys), F.count(F.lit(1)))


def run_checks(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out

