"""Whole results at any size, and runs that grow with what changed: audits list every
impacted id, records are not broadcast, merges leave other commits' files alone."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators.joins import join_file_meta
from ledgerline.plans import models, observability, silver
from ledgerline.sources import derived as D
from ledgerline.sources import sinks, versions
from ledgerline.sources.versions import read_table
from ledgerline.tables import load

#: More ids than audits once listed (2^20).
MANY = (1 << 20) + 5


def _blocks(spark, ids):
    return ids.select(F.col("id").alias("block_id"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("block_timestamp"),
                      F.lit(1).cast("bigint").alias("tx_count"))


def _listed(row):
    return row.agg(F.max("blocks_impacted_count").alias("n"), F.max(F.size("blocks_impacted_array")).alias("listed"),
                   F.max(F.get("blocks_impacted_array", F.lit(0))).alias("first"),
                   F.max(F.element_at("blocks_impacted_array", -1)).alias("last")).first()


def test_an_audit_lists_every_missing_block(spark, tmp_dir):
    ends = _blocks(spark, spark.createDataFrame([(0,), (MANY + 1,)], "id bigint"))
    out = models.run_blocks_audit(spark, ends, os.path.join(tmp_dir, "audit"), "2025-01-03 00:00:00", "2025-01-04 00:00:00")
    assert tuple(_listed(out)) == (MANY, MANY, 1, MANY)


def test_an_audit_lists_every_block_with_other_counts(spark):
    row = observability.transactions_completeness(
        _blocks(spark, spark.range(MANY)), spark.createDataFrame([], "block_id bigint"), "2025-01-03 00:00:00")
    assert tuple(_listed(row)) == (MANY, MANY, 0, MANY - 1)


def test_records_are_not_broadcast_to_meet_their_files(spark):
    # both sides are small by their estimate: 10 million records in packed files are, too
    meta = spark.createDataFrame([("f1", 1, "a"), ("f2", 1, "b"), (None, 2, "c")], "file_name string, partition_key int, at string")
    rec = spark.createDataFrame([("f1", 1), ("f1", 1), ("f3", 1), (None, 2), ("f2", 1)], "file_name string, partition_key int")
    j = join_file_meta(rec, meta)
    assert sorted(map(tuple, j.collect())) == [("f1", 1, "a"), ("f1", 1, "a"), ("f2", 1, "b")]
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan


def test_a_merge_rewrites_only_commits_that_hold_its_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    schema = "k int, v string, first string, p string"

    def put(*rows):
        sinks.upsert_table(spark, path, spark.createDataFrame(rows, schema), ["k"], "p", preserve=["first"])
        return versions.snapshot(spark, path)
    (a,) = put((1, "a", "1", "d"), (2, "a", "1", "d"), (3, "a", "1", "e")).parts["p=d"]
    b = put((4, "b", "2", "d"), (5, "b", "2", "d"), (None, "b", "2", "d")).parts["p=d"]
    assert b[0] == a and len(b) == 2                                    # new keys are added
    assert put((6, "c", "3", "d")).parts["p=d"][:2] == b
    c = put((2, "d", "4", "d")).parts["p=d"]
    assert a not in c and set(b[1:]) < set(c)                           # the other commits' files stay
    d = put((1, "e", "5", "e"), (4, "e", "5", "d"), (7, "e", "5", "d"), (None, "e", "5", "d")).parts
    assert not set(d["p=d"]) & {b[1], c[-1]} and any("k" in i for i in d["p=d"])
    rows = [tuple(r) for r in read_table(spark, path).collect()]
    assert sorted(rows, key=str) == sorted([
        (1, "e", "1", "e"), (2, "d", "1", "d"), (3, "a", "1", "e"), (4, "e", "2", "d"), (5, "b", "2", "d"),
        (6, "c", "3", "d"), (7, "e", "5", "d"), (None, "b", "2", "d"), (None, "e", "5", "d")], key=str)


def test_a_partition_of_many_commits_is_put_together(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_UNITS", 3)
    path = os.path.join(tmp_dir, "t")
    for k in range(5):
        sinks.upsert_table(spark, path, spark.createDataFrame([(k, "d")], "k int, p string"), ["k"], "p", moving=False)
    assert len(versions.snapshot(spark, path).parts["p=d"]) == 2
    assert sorted(r.k for r in read_table(spark, path).collect()) == [0, 1, 2, 3, 4]


def test_files_are_as_small_as_their_rows(spark, tmp_dir):
    # a filter of 1 MB in each of many small files filled the disk
    path = os.path.join(tmp_dir, "t")
    sinks.upsert_table(spark, path, spark.range(20).select(F.col("id").alias("block_id"), (F.col("id") % 4).alias("p")),
                       ["block_id"], "p", bloom_cols=["block_id"])
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/data/*/*/part-*")]
    assert sizes and max(sizes) < 50_000


def test_landed_lines_are_the_records(spark):
    lineitem, orders = load(spark, SF_SMALL, "lineitem").limit(300), load(spark, SF_SMALL, "orders").limit(300)
    nulls = spark.createDataFrame([(None,) * len(lineitem.columns)], lineitem.schema)
    txs, blocks = D.tx_versions(lineitem.unionByName(nulls)), D.block_versions(orders, lineitem)
    for records, lines in ((D.tx_records(txs), D.tx_lines(txs)), (D.block_records(blocks), D.block_lines(blocks))):
        a = records.select(F.to_json(F.struct("value", "data")).alias("line"))
        a, b = (sorted(r[0] for r in d.select(F.to_json(F.parse_json("line"))).collect()) for d in (a, lines))
        assert a == b and len(a) >= 300


def test_records_are_parsed_once(spark, tmp_dir):
    spark.createDataFrame([('{"value":{"BLOCK_ID_REQUESTED":1},"data":{"hash":"h"}}',), ("broken",),
                           ('{"value":{"BLOCK_ID_REQUESTED":2},"data":[]}',)], "v string").write.text(f"{tmp_dir}/in")
    got = silver.silver_transactions(models._landed_scan(spark, f"{tmp_dir}/in", None))
    assert [(r.block_id, r.tx_id) for r in got.collect()] == [(1, "h")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.data,") == 1
