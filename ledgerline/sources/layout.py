"""Upkeep of versioned tables (S9, S10): compaction with reclustering, and a
file-level index for point lookups.

Merges and appends leave small files, and files whose key ranges overlap.
:func:`compact` puts a bounded amount of them together, range-partitioned by the
cluster keys, as a commit that changes no row. :func:`index_table` keeps, for
every data file, the minimum and maximum of chosen columns and a Bloom filter of
their values, in Parquet tables beside the data; only files without an entry are
read for it. :func:`lookup` opens the files that may hold a value: those whose
range includes it and whose filter has all its bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .landing import _fs
from .sinks import write_table

INDEX = "_index"
#: Size that compaction aims at, and the share of it below which a file is small.
TARGET_BYTES, SMALL = 256 << 20, 0.5
#: Bloom filter: bits per row, hashes, bits per stored piece (fixed value: what
#: ``bitmap_construct_agg`` holds).
BITS_PER_ROW, HASHES, PIECE_BITS = 10, 5, 32_768
#: Values of one lookup.
MOST_VALUES = 1_000


def data_files(spark: SparkSession, path: str, snap: versions.Snapshot, names=None) -> dict[str, int]:
    """Data files of a version (path relative to the table) with their bytes."""
    out = {}
    root = path.rstrip("/")
    for folder in snap.folders(root, names):
        fs, p = _fs(spark, folder)
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if not name.startswith(("_", ".")):
                out[f"{folder[len(root) + 1:]}/{name}"] = s.getLen()
    return out


def compact(spark: SparkSession, path: str, sort_by: Sequence[str], bloom_cols: Sequence[str] = (),
            target_bytes: int = TARGET_BYTES, max_bytes: int | None = None) -> list[str]:
    """Rewrite partitions that hold more than one small file, or files of several
    commits, into files of about ``target_bytes`` with disjoint ranges of
    ``sort_by``. At most ``max_bytes`` of input are taken in one call (at least one
    partition), most files first, so upkeep can go on in steps beside merges. A
    merge that commits meanwhile wins; the next attempt starts from it. Returns
    the partitions' folder names."""
    def attempt():
        snap = versions.snapshot(spark, path)
        todo = []
        for name in snap.parts:
            sizes = list(data_files(spark, path, snap, [name]).values())
            small = sum(s < SMALL * target_bytes for s in sizes)
            if small > 1 or len(snap.parts[name]) > 1:
                todo.append((len(sizes), sum(sizes), name))
        picked, taken = [], 0
        for _, size, name in sorted(todo, reverse=True):
            if picked and max_bytes is not None and taken + size > max_bytes:
                continue
            picked.append(name)
            taken += size
        if not picked:
            return []
        rows = versions.read_parts(spark, path, snap, picked)
        files = max(len(picked), -(-taken // target_bytes))
        versions.commit(spark, path, snap, rows, snap.partition_col, drop=picked, changed=[], operation="compact",
                        write=lambda df, folder: write_table(df, folder, [snap.partition_col], sort_by, bloom_cols,
                                                             num_files=files))
        return picked
    return versions.retried(attempt)


# ------------------------------------------------------------- file index

def _index_path(path: str, kind: str) -> str:
    return f"{path.rstrip('/')}/{INDEX}/{kind}"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    fs, p = _fs(spark, path)
    return spark.read.parquet(path) if fs.exists(p) and len(fs.listStatus(p)) else None


def _relative(path: str):
    """A row's data file, relative to the table folder."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"({versions.DATA}/{versions.COMMIT}=[^/]+/[^/]+/[^/]+)$", 1)


def _piece(pos):
    return F.floor(pos / PIECE_BITS).cast("bigint")


def _positions(value, bits):
    return [F.pmod(F.xxhash64(F.lit(i), value), bits) for i in range(HASHES)]


def index_table(spark: SparkSession, path: str, cols: Sequence[str]) -> int:
    """Index the newest version's files that have no entry yet; returns their
    number. ``cols`` stay the same over a table's life. A filter has about
    ``BITS_PER_ROW`` bits a row, in pieces, so no row of the index grows with its
    file; each file is summarised with partial aggregation."""
    path = path.rstrip("/")
    snap = versions.snapshot(spark, path)
    have = _read(spark, _index_path(path, "ranges"))
    seen = set() if have is None else {r[0] for r in have.select("file").distinct().collect()}
    todo = [f for f in data_files(spark, path, snap) if f not in seen]
    if not todo:
        return 0
    rows = (spark.read.option("basePath", f"{path}/{versions.DATA}").schema(snap.schema)
            .parquet(*[f"{path}/{f}" for f in todo]).select(_relative(path).alias("file"), *cols))
    stats = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{k}_{c}") for c in cols for k, f in (("lo", F.min), ("hi", F.max))])
    stats = stats.withColumn("bits", F.greatest(F.lit(PIECE_BITS), F.ceil(F.col("n") * BITS_PER_ROW / PIECE_BITS)
                                                * PIECE_BITS).cast("bigint"))
    # filters first: a file counts as indexed once its range is there
    sized = rows.join(stats.select("file", "bits"), "file")
    for c in cols:
        pos = sized.where(F.col(c).isNotNull()).select("file", F.explode(F.array(*_positions(F.col(c), F.col("bits"))))
                                                       .alias("pos"))
        (pos.groupBy("file", _piece(F.col("pos")).alias("piece"))
         .agg(F.bitmap_construct_agg(F.pmod("pos", F.lit(PIECE_BITS))).alias("map"))
         .write.mode("append").parquet(_index_path(path, f"filter_{c}")))
    stats.coalesce(1).write.mode("append").parquet(_index_path(path, "ranges"))
    return len(todo)


def matching_files(spark: SparkSession, path: str, col: str, values: Sequence) -> list[str]:
    """Files of the newest version that may hold one of ``values`` (a list of at
    most ``MOST_VALUES``) in ``col``; files without an index entry count as such."""
    if len(values) > MOST_VALUES:
        raise ValueError(f"a lookup takes {MOST_VALUES} values; join the table for more")
    path = path.rstrip("/")
    snap = versions.snapshot(spark, path)
    live = data_files(spark, path, snap)
    ranges, filters = (_read(spark, _index_path(path, k)) for k in ("ranges", f"filter_{col}"))
    if ranges is None or filters is None:
        return sorted(live)
    kind = snap.schema[col].dataType
    wanted = F.array(*[F.lit(v).cast(kind) for v in values if v is not None])
    ranges = ranges.dropDuplicates(["file"])
    near = ranges.select("file", "bits", F.explode(F.filter(
        wanted, lambda v: (v >= F.col(f"lo_{col}")) & (v <= F.col(f"hi_{col}")))).alias("v"))
    probes = near.select("file", "v", F.explode(F.array(*_positions(F.col("v"), F.col("bits")))).alias("pos"))
    probes = probes.select("file", "v", _piece(F.col("pos")).alias("piece"), F.pmod("pos", F.lit(PIECE_BITS)).alias("bit"))
    byte = F.conv(F.hex(F.substring("map", (F.floor(F.col("bit") / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(bit % 8 as int)) & 1") == 1
    met = probes.join(filters, ["file", "piece"], "left").withColumn("__byte", byte)
    found = met.groupBy("file", "v").agg(F.min(F.coalesce(hit, F.lit(False))).alias("all")).where("all")
    may = {r[0] for r in found.select("file").distinct().collect()}
    known = {r[0] for r in ranges.select("file").collect()}
    return sorted(f for f in live if f in may or f not in known)


def lookup(spark: SparkSession, path: str, col: str, values: Sequence) -> DataFrame:
    """The newest version's rows with one of ``values`` in ``col``; only files that
    may hold one are opened."""
    path = path.rstrip("/")
    snap = versions.snapshot(spark, path)
    files = matching_files(spark, path, col, values)
    if not files:
        return spark.createDataFrame([], snap.schema)
    return (spark.read.option("basePath", f"{path}/{versions.DATA}").schema(snap.schema)
            .parquet(*[f"{path}/{f}" for f in files]).select(*snap.schema.names).where(F.col(col).isin(list(values))))


def drop_index_of_gone_files(spark: SparkSession, path: str) -> None:
    """Rewrite the index without files that no kept version names (after a
    vacuum). A crash in between leaves files without an entry, which are indexed
    again."""
    path = path.rstrip("/")
    live = {f for v in versions.versions(spark, path) for f in data_files(spark, path, versions.snapshot(spark, path, v))}
    keep = spark.createDataFrame([(f,) for f in live], "file string")
    fs, root = _fs(spark, f"{path}/{INDEX}")
    if not fs.exists(root):
        return
    # the ranges go last and come first, as they say which files are indexed
    kinds = sorted((s.getPath().getName() for s in fs.listStatus(root)), key=lambda k: k != "ranges")
    from .sinks import stage
    staged = {k: stage(spark, spark.read.parquet(f"{path}/{INDEX}/{k}").join(keep, "file", "left_semi")) for k in kinds}
    for k in kinds:
        fs.delete(_fs(spark, f"{path}/{INDEX}/{k}")[1], True)
    for k in reversed(kinds):
        staged[k].write.parquet(f"{path}/{INDEX}/{k}")
