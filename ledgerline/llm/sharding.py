"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring. A key belongs to the arc that
ends at the next point clockwise. A shard takes keys up to its bound; keys
that find it full continue clockwise to the next point whose shard has room.
With ``slack`` 0 the bounds are floor or ceiling of the mean, so row counts
differ by one at most; a larger slack keeps more keys at home and so moves
fewer when a shard is added.

The walk needs only the number of keys of each arc (``shards * vnodes``
numbers, whatever the input): one SQL fold over the ring turns them into
segments (arc, rank from, rank to, shard, first slot). A row then only needs
its rank within its arc. All steps are DataFrame or SQL functions.

Rows that agree in every input column are one weighted entry until the end,
so a repeated key never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import TARGET_ROWS, Scratch, expand_copies, prefix_sums, text_crc, utf8_bytes

#: Cells of the ring. Points and keys lie on cells.
CELLS = 1 << 16


def ring(spark: SparkSession, shards: int, vnodes: int, seed: int) -> DataFrame:
    """The points in clockwise order: arc (0, 1, ...), cell, shard. A point's
    place depends only on its shard, its number and the seed, so the points of
    the other shards stay where they are when a shard is added."""
    pts = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("v"))
    pts = pts.withColumn("cell", F.pmod(F.xxhash64(F.lit("point"), F.lit(seed), "shard", "v"),
                                        F.lit(CELLS)))
    w = Window.orderBy("cell", "shard", "v")                   # shards * vnodes rows
    return pts.select((F.row_number().over(w) - 1).alias("arc"), "cell", "shard")


def arcs_of_cells(points: DataFrame) -> DataFrame:
    """cell -> arc of the first point at or after it (CELLS rows)."""
    spark = points.sparkSession
    first = points.groupBy("cell").agg(F.min("arc").alias("a"))
    cells = spark.range(CELLS).withColumnRenamed("id", "cell").join(first, "cell", "left")
    w = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.select("cell", F.coalesce(F.last("a", ignorenulls=True).over(w),
                                           F.lit(0)).alias("arc"))


def segments(points: DataFrame, counts: DataFrame, shards: int, slack: float) -> DataFrame:
    """Walk the ring twice over the arcs' key counts (arc, n). Returns arc and
    its array of segments (lo, hi, shard, slot)."""
    arcs = (points.join(counts, "arc", "left")
            .select(F.struct("arc", "shard", F.coalesce("n", F.lit(0)).cast("long").alias("n")).alias("p"))
            .agg(F.array_sort(F.collect_list("p")).alias("arcs"),
                 F.coalesce(F.sum("p.n"), F.lit(0)).alias("total")))
    # exact bounds at slack 0: the first (total mod shards) shards take one more
    room = (f"transform(sequence(0, {shards - 1}), j -> cast(floor(total * {1 + slack!r} / {shards}) as bigint)"
            f" + if({slack!r} > 0 or j < total % {shards}, 1, 0))")
    item = "array<struct<arc:int,lo:bigint,hi:bigint>>"
    seg = "array<struct<arc:int,lo:bigint,hi:bigint,shard:int,slot:bigint>>"
    # the queue at a point: its own keys, then those that wait; the inner fold
    # only carries what the point's shard takes, the rest is a slice of the queue
    walk = f"""
    aggregate(
      concat(arcs, transform(arcs, p -> named_struct('arc', p.arc, 'shard', p.shard, 'n', 0L))),
      named_struct('room', {room}, 'used', transform(sequence(0, {shards - 1}), j -> 0L),
                   'wait', cast(array() as {item}), 'out', cast(array() as {seg})),
      (s, p) -> if(s.room[p.shard] = 0,
        named_struct('room', s.room, 'used', s.used, 'wait',
          if(p.n > 0, concat(array(named_struct('arc', p.arc, 'lo', 0L, 'hi', p.n)), s.wait), s.wait),
          'out', s.out),
        aggregate(array(if(p.n > 0, concat(array(named_struct('arc', p.arc, 'lo', 0L, 'hi', p.n)), s.wait), s.wait)),
          s, (o, queue) -> aggregate(queue,
            named_struct('room', o.room[p.shard], 'used', o.used[p.shard], 'k', 0, 'lo', 0L,
                         'new', cast(array() as {seg})),
            (t, q) -> if(t.room = 0, t, named_struct(
              'room', t.room - least(t.room, q.hi - q.lo),
              'used', t.used + least(t.room, q.hi - q.lo),
              'k', t.k + if(t.room >= q.hi - q.lo, 1, 0),
              'lo', if(t.room >= q.hi - q.lo, 0L, q.lo + t.room),
              'new', concat(t.new, array(named_struct('arc', q.arc, 'lo', q.lo,
                     'hi', q.lo + least(t.room, q.hi - q.lo), 'shard', p.shard, 'slot', t.used))))),
            t -> named_struct(
              'room', transform(o.room, (r, j) -> if(j = p.shard, t.room, r)),
              'used', transform(o.used, (u, j) -> if(j = p.shard, t.used, u)),
              'wait', if(t.lo > 0, concat(
                  array(named_struct('arc', queue[t.k].arc, 'lo', t.lo, 'hi', queue[t.k].hi)),
                  slice(queue, t.k + 2, greatest(size(queue) - t.k - 1, 0))),
                slice(queue, t.k + 1, greatest(size(queue) - t.k, 0))),
              'out', concat(o.out, t.new))))),
      s -> s.out)"""
    return (arcs.select(F.explode(F.expr(walk)).alias("g")).select("g.*")
            .groupBy("arc").agg(F.collect_list(F.struct("lo", "hi", "shard", "slot")).alias("segs")))


def ring_shards(keys: DataFrame, key: Column, shards: int, vnodes: int = 32, seed: int = 0,
                slack: float = 0.0, copies: str = "copies") -> DataFrame:
    """Place distinct ``keys`` rows, each standing for ``copies`` equal rows.

    Returns one row per copy: the columns of ``keys`` without ``copies``, plus
    ``shard`` and ``slot`` (gapless from 0 within the shard). The result
    depends on the rows' contents only, not on files, tasks or order. Null
    keys hash like any value; an empty input gives no rows."""
    spark = keys.sparkSession
    cols = [c for c in keys.columns if c != copies]
    points = ring(spark, shards, vnodes, seed)
    lookup = arcs_of_cells(points)                     # CELLS rows: a fixed, small broadcast
    keys = (keys.withColumn("cell", F.pmod(F.xxhash64(F.lit("key"), F.lit(seed), key), F.lit(CELLS)))
            .join(F.broadcast(lookup), "cell").drop("cell")
            .withColumn("__k", F.xxhash64(F.lit("order"), F.lit(seed), *cols)))
    counts = keys.groupBy("arc").agg(F.sum(copies).alias("n"), F.count("*").alias("entries"))
    most = counts.agg(F.max("entries")).first()[0] or 1
    ranked = prefix_sums(keys, ["arc"], "__k", {"lo": copies}, cols,
                         max(1, round(most / TARGET_ROWS)))
    segs = segments(points, counts, shards, slack)     # shards * vnodes rows at most
    placed = (ranked.withColumn("hi", F.col("lo") + F.col(copies))
              .join(F.broadcast(segs), "arc")
              .withColumn("g", F.explode(F.filter("segs", lambda g: (g["lo"] < F.col("hi")) & (g["hi"] > F.col("lo")))))
              .select(*cols, F.col("g.shard").alias("shard"),
                      (F.col("g.slot") + F.greatest("lo", "g.lo") - F.col("g.lo")).alias("from"),
                      (F.col("g.slot") + F.least("hi", "g.hi") - F.col("g.lo")).alias("to")))
    return expand_copies(placed, "from", "to", "slot").drop("from", "to")


def shard_documents(docs: DataFrame, shards: int = 24, vnodes: int = 32, seed: int = 0,
                    slack: float = 0.0) -> DataFrame:
    """Documents on the ring by doc_id: doc_id, size (UTF-8 bytes + 8),
    text_crc32, shard, slot. Null text has size 8 and the CRC of nothing; a
    null doc_id is a key like any other; repeated rows get slots of their own;
    other columns are not read."""
    keys = (docs.select("doc_id", (utf8_bytes(F.col("text")) + 8).alias("size"),
                        text_crc(F.col("text")).alias("text_crc32"))
            .groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")))
    keys = Scratch(docs.sparkSession, "ring").save(keys)      # read twice: arc counts, then ranks
    return ring_shards(keys, F.col("doc_id"), shards, vnodes, seed, slack)


def op6(docs: DataFrame, shards: int = 24) -> DataFrame:
    return shard_documents(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
