"""Ranks over partitions that are cut at sketched quantiles."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import windows
from ledgerline.operators.windows import bounded_buckets, rank0


def hot(spark, n=30_000):
    """A third of all rows are one (user, type, day); a third of those tie."""
    d = spark.range(n).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1_000_003)))
    return d.select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("u"), F.col("h") % 50))
        .alias("user"), F.when(F.col("id") % 9 == 0, F.lit(777)).when(F.col("id") % 101 == 5, F.lit(None))
        .otherwise(F.col("h") % 20_000).cast("int").alias("o"))


def ranks(df):
    return {r.id: r.rank for r in df.collect()}


@pytest.mark.parametrize("kind", ["int", "timestamp_ntz", "double"])
def test_equals_the_plain_rank(spark, kind):
    df = hot(spark)
    o = {"int": F.col("o"), "double": F.col("o") / 7, "date": F.date_add(F.lit("1970-01-05").cast("date"), F.col("o"))}
    df = df.withColumn("o", o.get(kind, F.timestamp_seconds("o").cast(kind) if kind.startswith("t") else None))
    want = ranks(rank0(df, "user", "o", "rank"))
    assert ranks(rank0(df, ["user"], "o", "rank", rows=500)) == want


def test_no_bucket_above_the_bound(spark):
    """The bound holds for the windows' groups; only ties on a splitter, which
    need no window, are more. One task then never sorts more than the bound."""
    df, rows = hot(spark, 60_000), 1_000
    d, split = bounded_buckets(df, "user", "o", rows)
    assert split
    per = d.groupBy(windows._P, windows._PATH).agg(F.count("*").alias("n"), F.countDistinct("o").alias("v")).collect()
    assert max(r.n for r in per if r[windows._PATH][-1] % 2 == 0) <= rows
    ties = [r for r in per if r[windows._PATH][-1] % 2 == 1]
    assert all(r.v <= 1 for r in ties) and max(r.n for r in ties) > 5_000
    out = rank0(df, "user", "o", "rank", rows=rows)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_levels_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(windows, "FAN", 4)                     # so one level is not enough
    df = hot(spark, 20_000)
    d, _ = bounded_buckets(df, "user", "o", 300)
    assert d.agg(F.max(F.size(windows._PATH))).first()[0] >= 4
    assert ranks(rank0(df, "user", "o", "rank", rows=300)) == ranks(rank0(df, "user", "o", "rank"))


def test_small_partitions_and_no_partition(spark):
    df = hot(spark, 900)
    assert ranks(rank0(df, None, "o", "rank", rows=100)) == ranks(rank0(df, None, "o", "rank"))
    plan = rank0(df, "user", "o", "rank", rows=1_000)._jdf.queryExecution().toString()
    assert "Join" not in plan                                   # nothing to cut: one window
    assert rank0(df.limit(0), "user", "o", "rank", rows=10).count() == 0
    nulls = df.withColumn("o", F.lit(None).cast("int"))
    assert set(ranks(rank0(nulls, "user", "o", "rank", rows=10)).values()) == {0}
    with pytest.raises(ValueError):
        rank0(df.withColumn("o", F.lit("x")), "user", "o", "rank", rows=10)
