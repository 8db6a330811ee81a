"""Table sinks (S8–S10) and incremental table writes (I4–I7 on storage).

Model tables are versioned (:mod:`.versions`), partitioned by a derived cluster
key. An incremental write reads the touched partitions of a pinned version,
merges them with the batch, writes the result to files of its own and publishes
it as the next version, which keeps all other partitions' files (I6): readers and
crashes see the old or the new version only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import replace_keys, upsert
from ..session import checkpoint_dir
from . import versions
from .versions import exists, read_table


#: Tables and staged copies keep a VARIANT whole: it is read whole, and finding a schema to
#: shred it by, then putting it together again, takes several times the rest of the write and
#: read. A Bloom filter is as large as its file's values need, 2 kB to 1 MB (else 1 MB in every file).
WRITE = {"compression": "zstd", "spark.sql.variant.inferShreddingSchema": "false",
         "parquet.bloom.filter.adaptive.enabled": "true"}


#: A merge puts a partition's files together once they are of so many commits.
MOST_UNITS = 64
#: Commits whose rewritten rows a merge keeps apart; those of more are put together.
MOST_APART = 8


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = (), bloom_cols: Sequence[str] = (),
                mode: str = "overwrite", num_files: int | None = None,
                dynamic: bool = False) -> None:
    """Write Parquet, partitioned by ``partition_by``, rows clustered
    by ``sort_by`` (tight row-group min/max → pruning) and Parquet bloom
    filters on ``bloom_cols`` for point lookups (tx_id).

    Range partitioning on (partition, sort) keys sizes write tasks by
    sampled row counts, so a hot partition value is split over several
    tasks/files instead of landing in one."""
    w = df
    keys = list(partition_by) + list(sort_by)
    if keys:
        w = (w.repartitionByRange(num_files, *keys) if num_files
             else w.repartitionByRange(*keys))
        w = w.sortWithinPartitions(*keys)
    writer = w.write.mode(mode).options(**WRITE)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for c in bloom_cols:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.candidates.number#{c}", "10"))
    writer.parquet(path)


def _staging_path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/staging/{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once to a fresh folder in the shared
    checkpoint folder and read it back (survives executor loss; unlike
    ``checkpoint()`` without persist, the plan is computed once)."""
    p = path or _staging_path(spark)
    df.write.mode("overwrite").options(**WRITE).parquet(p)
    return spark.read.parquet(p)


def _release(spark: SparkSession, path: str) -> None:
    """Drop a merge's staged copy once the merge has committed (no-op
    without a JVM gateway; a crash before this leaves only garbage)."""
    from .landing import _fs
    fs, p = _fs(spark, path)
    if fs is not None and fs.exists(p):
        fs.delete(p, True)


def _unique_batch(batch: DataFrame, keys: Sequence[str]) -> None:
    twice = batch.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate merge key in the batch: {twice[0].asDict()}")


def _layout(partition_col: str, sort_by: Sequence[str], bloom_cols: Sequence[str]):
    return lambda df, folder: write_table(df, folder, [partition_col], sort_by, bloom_cols)


def _values(df: DataFrame, col: str) -> list[str | None]:
    """A partition column's values as strings (a partition value is a table's
    date or key bucket: far fewer than rows)."""
    return [r[0] for r in df.select(F.col(col).cast("string")).distinct().collect()]


def _hours(ts: str | None):
    """The written rows' hours as a version's changes."""
    return None if ts is None else lambda written: versions.hour_runs(written, ts)


def overwrite_table(spark: SparkSession, path: str, df: DataFrame, partition_col: str,
                    sort_by: Sequence[str] = (), bloom_cols: Sequence[str] = (),
                    track: Sequence[str] = (), changed_ts: str | None = None,
                    sources: dict[str, int] | None = None, notes: dict | None = None,
                    stream: tuple[str, int] | None = None) -> dict:
    """First load or full refresh: ``df`` becomes the whole table."""
    def attempt():
        base = versions.snapshot(spark, path)
        return versions.commit(spark, path, base, df, partition_col, fresh=True,
                               write=_layout(partition_col, sort_by, bloom_cols), track=track,
                               changed=_hours(changed_ts), sources=sources, notes=notes,
                               stream=stream, operation="overwrite")
    return versions.retried(attempt).marks


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                 partition_col: str, preserve: Sequence[str] = (),
                 sort_by: Sequence[str] = (), track: Sequence[str] = (),
                 bloom_cols: Sequence[str] = (), moving: bool = True,
                 changed_ts: str | None = None, sources: dict[str, int] | None = None,
                 stream: tuple[str, int] | None = None, newest: Sequence[str] = ()) -> dict:
    """I4/I5/I6 MERGE into a versioned table. The batch is evaluated once
    (staged); a key twice in it is an error. Only the commits' files of a partition
    that hold a key of the batch are rewritten; new keys are added. ``moving``: a
    key's partition may differ from the stored one, so the batch's keys are looked
    up in all partitions (reading keys only); pass False where the partition derives
    from the key. ``stream``: (id, epoch) of a
    micro-batch; an epoch that a version records is not merged again.
    ``changed_ts``: the version lists the hours of that column in the batch and
    in the rows it replaced. ``newest``: a stored row stays unless the batch's is
    greater in these columns (NULLs least), so arrival order does not matter.
    Returns the table's high-water marks."""
    if versions.seen_epoch(versions.snapshot(spark, path), stream):
        return versions.snapshot(spark, path).marks
    batch_path = _staging_path(spark)
    batch = stage(spark, batch, batch_path)
    _unique_batch(batch, keys)
    write = _layout(partition_col, sort_by, bloom_cols)
    common = {"write": write, "track": track, "sources": sources, "stream": stream}

    def attempt():
        base = versions.snapshot(spark, path)
        if versions.seen_epoch(base, stream):
            return base
        if base is None:
            return versions.commit(spark, path, None, batch, partition_col, changed=_hours(changed_ts),
                                   operation="create", **common)
        names, own = base.named(_values(batch, partition_col)), batch.select(*keys)
        # a commit's files of a partition without any of these keys stay as they are
        units = versions.units_of(spark, path, base, batch, keys, None if moving else names)
        full = {n for n in {*names, *(n for n, _ in units)} if len(base.parts[n]) >= MOST_UNITS}
        units += [(n, c) for n in full for c in base.parts[n] if (n, c) not in set(units)]
        touched = versions.read_units(spark, path, base, units)
        put = batch
        if newest:
            at = F.struct(*newest)
            old = touched.select(*keys, at.alias("__old"))
            put = batch.join(old, list(keys), "left").where(
                F.col("__old").isNull() | (at > F.col("__old"))).select(*batch.columns)
            own = put.select(*keys)
        changed = None
        if changed_ts is not None:
            replaced = touched.join(own, list(keys), "left_semi").select(changed_ts)
            changed = versions.hour_runs(replaced.unionByName(put.select(changed_ts)), changed_ts)
        of = sorted({c for _, c in units})
        kept = []
        if not full and 1 < len(of) <= MOST_APART:
            # each commit's other rows stay by themselves: together they would be rewritten whenever one is touched
            kept = [versions.read_units(spark, path, base, [u for u in units if u[1] == c])
                    .join(own, list(keys), "left_anti") for c in of]
            touched = (touched.join(own, list(keys), "left_semi") if preserve
                       else spark.createDataFrame([], base.schema))
        return versions.commit(spark, path, base, upsert(touched, put, keys, preserve), partition_col, append=True,
                               units=units, kept=kept, changed=changed, operation="merge", **common)
    marks = versions.retried(attempt).marks
    _release(spark, batch_path)
    return marks


def load_watermarks(spark: SparkSession, path: str) -> dict:
    """High-water marks of the newest version (empty for a missing table)."""
    snap = versions.snapshot(spark, path)
    return {} if snap is None else snap.marks


def replace_table_keys(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str],
                       partition_col: str, sort_by: Sequence[str] = (), bloom_cols: Sequence[str] = (),
                       track: Sequence[str] = (), changed_ts: str | None = None,
                       sources: dict[str, int] | None = None, notes: dict | None = None,
                       stream: tuple[str, int] | None = None, gone: DataFrame | None = None) -> None:
    """I7 delete+insert: periods present in the batch, and those in ``gone`` (the
    key and partition columns of periods left without rows), are replaced whole.
    The batch is evaluated once; only these partitions are read and rewritten."""
    if versions.seen_epoch(versions.snapshot(spark, path), stream):
        return
    batch_path = _staging_path(spark)
    batch = stage(spark, batch, batch_path)

    def attempt():
        base = versions.snapshot(spark, path)
        if versions.seen_epoch(base, stream):
            return base
        periods = batch.select(*keys, partition_col)
        periods = periods if gone is None else periods.unionByName(gone.select(*keys, partition_col))
        names = [] if base is None else base.named(_values(periods, partition_col))
        rows = batch if base is None else replace_keys(
            versions.read_parts(spark, path, base, names), batch, keys, periods)
        return versions.commit(spark, path, base, rows, partition_col, drop=names,
                               write=_layout(partition_col, sort_by, bloom_cols), track=track,
                               changed=None if changed_ts is None else versions.hour_runs(periods, changed_ts),
                               sources=sources, notes=notes, stream=stream, operation="replace")
    versions.retried(attempt)
    _release(spark, batch_path)


def append_table(spark: SparkSession, path: str, batch: DataFrame, partition_col: str,
                 sort_by: Sequence[str] = (), bloom_cols: Sequence[str] = (),
                 track: Sequence[str] = (), changed_ts: str | None = None,
                 stream: tuple[str, int] | None = None) -> dict:
    """Insert without a merge: the batch's files join their partitions' (many
    small appends are put together by :func:`ledgerline.sources.layout.compact`)."""
    def attempt():
        base = versions.snapshot(spark, path)
        if versions.seen_epoch(base, stream):
            return base
        return versions.commit(spark, path, base, batch, partition_col, append=True,
                               write=_layout(partition_col, sort_by, bloom_cols), track=track,
                               changed=_hours(changed_ts), stream=stream, operation="append")
    return versions.retried(attempt).marks


def write_worklist(worklist: DataFrame, path: str, order_by: str | Sequence[str], batch_size: int,
                   limit: int | None = None, worker_batch_size: int | None = None) -> int:
    """Publish a work-list for an external fetcher as JSON lines, in
    ``order_by`` order (all requests; at most ``limit`` if one is given), one
    folder per producer batch (rows carry ``worker_batch_id`` when
    ``worker_batch_size`` is given). The list is landed first, as numbering the
    batches reads it twice. Returns the number of requests."""
    from ..plans.fetching import with_batches
    spark = worklist.sparkSession
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    landed_at = _staging_path(spark)
    wl = stage(spark, worklist.orderBy(*order).limit(limit) if limit else worklist, landed_at)
    with_batches(wl, order, batch_size, worker_batch_size).write.mode("overwrite") \
        .partitionBy("batch_id").json(path)
    n = wl.count()                                   # from the landed files' footers
    _release(spark, landed_at)
    return n
