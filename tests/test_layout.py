"""Compaction and the file index of versioned tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import layout, sinks, versions
from ledgerline.sources.versions import read_table

ROWS = "k bigint, id string, p string"


def batch(spark, lo, hi, p):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("id"),
                                      F.lit(p).alias("p"))


def opened(df):
    df.write.format("noop").mode("overwrite").save()
    return len(df.inputFiles())


def test_lookup_opens_matching_files_after_50_merges(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    parts = 10
    for n in range(50):
        sinks.upsert_table(spark, path, batch(spark, n * 100, n * 100 + 100, f"p{n % parts}"), ["k"], "p", moving=False,
                           sort_by=["k"])
        if n % 25 == 24:
            layout.index_table(spark, path, ["k", "id"])
    whole = read_table(spark, path)
    total = len(whole.inputFiles())
    assert whole.count() == 5_000 and total >= parts
    import hashlib
    ids = [hashlib.md5(str(i).encode()).hexdigest() for i in (7, 1_234)]
    got = layout.lookup(spark, path, "id", ids)                  # random keys: only the filters help
    assert sorted(r.k for r in got.collect()) == [7, 1_234] and opened(got) == 2
    assert layout.matching_files(spark, path, "id", ["no such id", None]) == []
    assert layout.lookup(spark, path, "id", ["zzz"]).count() == 0
    # what compaction gives: the same rows, disjoint ranges, a few files of the index's own
    before = sorted(tuple(r) for r in whole.collect())
    seen = versions.snapshot(spark, path).version
    done = layout.compact(spark, path, ["k"], ["id"], target_bytes=20_000)
    assert done == [] or versions.changed_hours(spark, path, seen) == []
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == before
    layout.index_table(spark, path, ["k", "id"])
    one = layout.lookup(spark, path, "k", [4_321])
    assert [r.k for r in one.collect()] == [4_321] and opened(one) == 1


def test_compaction_joins_appends_in_steps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    for n in range(8):
        sinks.append_table(spark, path, batch(spark, n, 2_000 + n, "ab"[n % 2]), "p", sort_by=["k"])
    snap = versions.snapshot(spark, path)
    assert {len(c) for c in snap.parts.values()} == {4}
    before = sorted(tuple(r) for r in read_table(spark, path).collect())
    size = sum(layout.data_files(spark, path, snap).values())
    assert len(layout.compact(spark, path, ["k"], max_bytes=size // 2 + 1)) == 1      # one partition a step
    assert len(layout.compact(spark, path, ["k"], max_bytes=size // 2 + 1)) == 1
    assert layout.compact(spark, path, ["k"]) == []
    now = versions.snapshot(spark, path)
    assert {len(c) for c in now.parts.values()} == {1} and sorted(tuple(r) for r in read_table(spark, path).collect()) == before
    assert sorted(tuple(r) for r in read_table(spark, path, snap.version).collect()) == before
    # cut by key: files of a partition do not overlap
    layout.compact(spark, path, ["k"], target_bytes=1 << 12)
    sinks.append_table(spark, path, batch(spark, 50, 60, "a"), "p")
    layout.compact(spark, path, ["k"], target_bytes=1 << 14)
    per = sorted((r.lo, r.hi) for r in read_table(spark, path).where("p = 'a'").groupBy(F.input_file_name()).agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    assert len(per) > 1 and all(a[1] <= b[0] for a, b in zip(per, per[1:]))


def test_compaction_gives_way_to_a_merge(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    for n in range(3):
        sinks.append_table(spark, path, batch(spark, n * 10, n * 10 + 10, "a"), "p")
    real, raced = versions._publish, []

    def late(spark_, p, snap):
        if not raced:
            raced.append(1)
            sinks.upsert_table(spark, path, batch(spark, 100, 101, "a"), ["k"], "p", moving=False)
        real(spark_, p, snap)
    monkeypatch.setattr(versions, "_publish", late)
    layout.compact(spark, path, ["k"])
    assert read_table(spark, path).count() == 31


def test_index_edge_cases(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(None, None, "a"), (1, "x", "a"), (1, "x", None)], ROWS)
    sinks.append_table(spark, path, df, "p")
    assert layout.lookup(spark, path, "k", [1]).count() == 2                 # no index yet: every file
    assert layout.index_table(spark, path, ["k", "id"]) >= 2 and layout.index_table(spark, path, ["k", "id"]) == 0
    sinks.append_table(spark, path, spark.createDataFrame([(2, "y", "b")], ROWS), "p")
    assert layout.lookup(spark, path, "k", [2, 1, None]).count() == 3        # a file without an entry is opened
    assert layout.lookup(spark, path, "id", ["y"]).count() == 1
    with pytest.raises(ValueError):
        layout.lookup(spark, path, "k", list(range(2_000)))
    sinks.overwrite_table(spark, path, spark.createDataFrame([(5, "q", "a")], ROWS), "p")
    versions.vacuum(spark, path, keep=1, grace_hours=-1)
    layout.index_table(spark, path, ["k", "id"])
    layout.drop_index_of_gone_files(spark, path)
    assert spark.read.parquet(f"{path}/_index/ranges").count() == 1
    assert [r.k for r in layout.lookup(spark, path, "id", ["q", "x"]).collect()] == [5]


def test_large_filters_have_no_false_negatives(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = batch(spark, 0, 20_000, "a").repartition(4)
    df.write.parquet(os.path.join(tmp_dir, "raw"))
    sinks.append_table(spark, path, df, "p", sort_by=["id"])
    layout.index_table(spark, path, ["id"])
    wanted = [r.id for r in df.where("k % 97 = 0").select("id").collect()][:200]
    assert layout.lookup(spark, path, "id", wanted).count() == len(wanted)
    assert spark.read.parquet(f"{path}/_index/filter_id").where("piece > 0").count() > 0
