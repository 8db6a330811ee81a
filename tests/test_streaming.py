"""Streams into versioned tables: replayed micro-batches, corrected hours, the
newest row of a key under any order of arrival."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.windows import latest_by_key
from ledgerline.plans import models
from ledgerline.plans.stats import hourly_metrics
from ledgerline.sources import sinks, versions
from ledgerline.sources.versions import read_table
from ledgerline.streaming import latest_stream, live, stream_hours, stream_table, stream_upsert

TX = "block_id bigint, tx_id string, tx_succeeded boolean, gas_used bigint, t string"


def txs(spark, rows):
    return spark.createDataFrame(rows, TX).select("block_id", "tx_id", "tx_succeeded", "gas_used",
                                                  F.to_timestamp_ntz("t").alias("block_timestamp"))


def arrivals(spark, folder, frames):
    """One file per frame, read one per micro-batch in that order."""
    for n, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            if f.startswith("part-") and not f.startswith("part-9"):
                os.utime(os.path.join(folder, f), (1_700_000_000 + n, 1_700_000_000 + n))
                os.rename(os.path.join(folder, f), os.path.join(folder, f"part-9{n:03d}.parquet"))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


def done(query):
    query.awaitTermination(180)
    assert query.exception() is None


def forget_last_commit(checkpoint):
    """As after a crash between the sink's commit and the stream's own."""
    folder = os.path.join(checkpoint, "commits")
    last = max(int(f) for f in os.listdir(folder) if f.isdigit())
    os.remove(os.path.join(folder, str(last)))
    crc = os.path.join(folder, f".{last}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_replayed_batch_counts_once(spark, tmp_dir):
    path, ck = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "ck")
    log = os.path.join(tmp_dir, "log")
    stream = arrivals(spark, os.path.join(tmp_dir, "in"), [
        txs(spark, [(1, "a", True, 5, "2025-01-01 00:10:00"), (2, "b", True, 6, "2025-01-01 01:10:00")]),
        txs(spark, [(2, "b", False, 7, "2025-01-01 01:20:00"), (3, "c", True, 8, "2025-01-02 00:10:00")])])

    def go():
        done(stream_table(stream, lambda d: d, path, ["tx_id"], "block_timestamp", ck))

    def rows():
        return sorted((r.tx_id, r.gas_used) for r in read_table(spark, path).collect())
    go()
    assert rows() == [("a", 5), ("b", 7), ("c", 8)] and versions.versions(spark, path) == [0, 1]
    forget_last_commit(ck)
    go()                                                       # the same epoch again
    assert rows() == [("a", 5), ("b", 7), ("c", 8)] and versions.versions(spark, path) == [0, 1]
    # an append shows every record: none is there twice
    ck2 = os.path.join(tmp_dir, "ck2")

    def add():
        done(stream_upsert(stream, lambda d: d.withColumn("d", F.to_date("block_timestamp")), lambda df, e: sinks.append_table(
            spark, log, df, "d", stream=live.epoch_of(df, e)), ck2))
    add()
    forget_last_commit(ck2)
    add()
    assert read_table(spark, log).count() == 4
    done(stream_table(stream, lambda d: d, path, ["tx_id"], "block_timestamp", os.path.join(tmp_dir, "ck3")))
    assert len(versions.snapshot(spark, path).streams) == 2    # a stream started anew has its own epochs


def hours(df):
    return sorted((str(r.block_timestamp_hour), r.block_count, r.transaction_count, r.transaction_count_success,
                   r.total_gas_used) for r in df.collect())


def test_late_rows_correct_published_hours(spark, tmp_dir, monkeypatch):
    facts, path, ck = (os.path.join(tmp_dir, x) for x in ("f", "h", "ck"))
    waves = [
        [(1, "a", True, 5, "2025-01-01 00:10:00"), (2, "b", True, 6, "2025-01-09 01:10:00")],
        [(3, "c", False, 7, "2025-01-01 00:20:00")],                       # eight days late
        [(2, "b", True, 9, "2025-01-01 02:10:00"), (4, "d", True, 1, "2025-01-09 05:00:00")],   # leaves its hour empty
        [(2, "b", True, 1, "2024-12-31 23:00:00")]]                        # an older copy: newest wins
    order = [0, 0, 1, 0]
    frames = [txs(spark, w).withColumn("ver", F.lit(v)) for w, v in zip(waves, order)]
    seen = []
    real = live.follow_hours

    def follow(spark_, f, p):
        real(spark_, f, p)
        seen.append(hours(read_table(spark_, p)))
    monkeypatch.setattr(live, "follow_hours", follow)
    stream = arrivals(spark, os.path.join(tmp_dir, "in"), frames)
    done(stream_hours(stream, facts, path, ck, newest=["ver"]))
    assert [h[:16] for h, *_ in seen[0]] == ["2025-01-01 00:00", "2025-01-09 01:00"]
    assert seen[1][0][2:] == (2, 1, 12)                                    # the late row is in
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2]).where("ver = 1 or tx_id <> 'b'")
    assert seen[2] == seen[3] == hours(read_table(spark, path)) == hours(hourly_metrics(whole))
    # a crash after the facts' commit: the replay finds the epoch and the hours catch up
    monkeypatch.undo()
    more = txs(spark, [(9, "z", True, 100, "2025-01-01 00:30:00")]).withColumn("ver", F.lit(0))
    more.coalesce(1).write.mode("append").parquet(os.path.join(tmp_dir, "in"))
    monkeypatch.setattr(live, "follow_hours", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    q = stream_hours(stream, facts, path, ck, newest=["ver"])
    with pytest.raises(Exception, match="crash"):
        q.awaitTermination(180)
    monkeypatch.undo()
    n = versions.versions(spark, facts)
    done(stream_hours(stream, facts, path, ck, newest=["ver"]))
    assert versions.versions(spark, facts) == n
    assert hours(read_table(spark, path)) == hours(hourly_metrics(whole.unionByName(more)))


def test_latest_wins_under_any_arrival(spark, tmp_dir):
    rows = [(k, v, None if (k + v) % 11 == 0 else (v * 7 + k) % 13, f"{k}-{v}") for k in range(12) for v in range(20)]
    rows += [(None, 1, 3, "n1"), (None, 2, 5, "n2"), (99, None, None, "only")]
    df = spark.createDataFrame(rows, "k int, v int, o int, s string")
    want = sorted(tuple(r) for r in latest_by_key(df, ["k"], [F.col("o").desc_nulls_last(), F.col("v").asc_nulls_last()])
                  .fillna(-1, ["k"]).fillna(-1, ["v", "o"]).collect())
    for seed in (1,):
        src = os.path.join(tmp_dir, f"in{seed}")
        mixed = df.withColumn("__p", F.pmod(F.hash("s", F.lit(seed)), F.lit(4)))
        stream = arrivals(spark, src, [mixed.where(F.col("__p") == p).drop("__p") for p in range(4)])
        path = os.path.join(tmp_dir, f"t{seed}")
        latest = latest_stream(stream, ["k"], [("o", True), ("v", False)])
        done(latest.writeStream.outputMode("update").option("checkpointLocation", os.path.join(tmp_dir, f"ck{seed}"))
             .foreachBatch(lambda b, e: sinks.upsert_table(
                 spark, path, b.withColumn("kk", F.coalesce("k", F.lit(-1))).withColumn("p", F.lit("x")), ["kk"], "p",
                 stream=live.epoch_of(b, e))).trigger(availableNow=True).start())
        got = sorted(tuple(r) for r in read_table(spark, path).select(*df.columns).fillna(-1, ["k"])
                     .fillna(-1, ["v", "o"]).collect())
        assert got == want


def test_state_of_old_keys_goes_and_the_sink_stays_right(spark, tmp_dir):
    def at(k, o, t):
        return spark.createDataFrame([(k, o, t)], "k int, o int, t string").select("k", "o", F.to_timestamp("t").alias("ts"))
    frames = [at(1, 5, "2025-01-01 00:00:00"), at(2, 1, "2025-01-09 00:00:00"), at(3, 1, "2025-01-09 01:00:00"),
              at(1, 2, "2025-01-09 02:00:00")]       # older by its order, after key 1's state went
    stream = arrivals(spark, os.path.join(tmp_dir, "in"), frames)
    emitted, path = [], os.path.join(tmp_dir, "t")

    def sink(b, e):
        emitted.extend((r.k, r.o) for r in b.collect())
        sinks.upsert_table(spark, path, b.withColumn("p", F.lit("x")), ["k"], "p", newest=["o"],
                           stream=live.epoch_of(b, e))
    done(latest_stream(stream, ["k"], [("o", True)], ts="ts", delay="1 hour", keep_hours=2)
         .writeStream.outputMode("update").option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .foreachBatch(sink).trigger(availableNow=True).start())
    assert (1, 2) in emitted                          # the timer had cleared the key
    assert sorted((r.k, r.o) for r in read_table(spark, path).collect()) == [(1, 5), (2, 1), (3, 1)]


def test_models_grain_is_restored():
    before = dict(models.CLUSTER_GRAIN)
    with models.cluster_grain("year"):
        assert models.CLUSTER_GRAIN["grain"] == "year"
    assert models.CLUSTER_GRAIN == before
