"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: a bit is 1 if it is set in over half of the text's shingle
hashes (XXH64, seed 42, of word shingles).

Covering LSH: every bit position i gets a non-zero vector phi(i) of r + 1 bits;
for each non-zero v of r + 1 bits, table v keeps the positions whose phi(i)
has odd overlap with v. The positions in which two fingerprints within r bits
differ span at most r dimensions, so some v is orthogonal to all of them and
that table's mask keeps none of them: the pair collides there, always.

Only distinct fingerprints are hashed, so copies never meet in a bucket. A
bucket is read as a sorted stream and gives a spanning forest of its links,
not its pairs. Buckets above ``BUCKET`` members are cut into tiles and every
pair of tiles is compared in a group of its own; nothing is capped.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components

SEED = 42
#: Members of a bucket that are compared at once; beyond, the tile size.
BUCKET = 2048


def simhash(text: bytes, k: int) -> int:
    """Signed 64-bit fingerprint of UTF-8 ``text``; 0 if it has no words.
    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and space only."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
        return int(np.array(hashes, np.uint64).view(np.int64)[0])
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):                      # long texts in pieces
        hi = min(n, at + (1 << 16))
        hashes = np.fromiter((xxhash.xxh64_intdigest(line[s:e - 1], SEED)
                              for s, e in zip(starts[at:hi], ends[at + k - 1:hi + k - 1])),
                             np.uint64, hi - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) for every row, with ``hashed`` also text_hash; null text
    counts as empty."""
    more = ["text_hash"] if hashed else []

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([simhash(t or b"", shingle) for t in texts], pa.int64()),
                 *[b.column(2) for _ in more]], names=["doc_id", "fp", *more])
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                        *[F.xxhash64("text").alias(c) for c in more])
            .mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in more)))


def covering_masks(radius: int) -> list[int]:
    """2^(r+1) - 1 signed 64-bit masks."""
    n = (1 << (radius + 1)) - 1
    phi = [i % n + 1 for i in range(64)]
    out = []
    for v in range(1, n + 1):
        mask = sum(1 << i for i in range(64) if (phi[i] & v).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, first member) of each connected part of one bucket."""
    n = len(fps)
    if n == 2:
        near = np.bitwise_count((fps[:1] ^ fps[1:]).view(np.uint64))[0] <= radius
        return (fps[1:], fps[:1]) if near else (fps[:0], fps[:0])
    x = fps.view(np.uint64)
    left = np.ones(n, bool)
    a, b = [], []
    for i in range(n):
        if not left[i]:
            continue
        left[i] = False
        todo = [i]
        while todo:
            j = todo.pop()
            rest = np.flatnonzero(left)
            hit = rest[np.bitwise_count(x[rest] ^ x[j]) <= radius]
            left[hit] = False
            a.extend(fps[hit])
            b.extend([fps[i]] * len(hit))
            todo.extend(hit.tolist())
    return np.array(a, np.int64), np.array(b, np.int64)


def _bucket_links(radius: int, limit: int | None):
    """Streams rows (bucket, fp) sorted by bucket. Yields kind 0: a link
    (a, b); kind 1: bucket, member, tile of a bucket above ``limit``."""
    def run(batches):
        key, part, tile = None, [], 0
        kinds, a, b, t = [], [], [], []

        def put(kind, x, y, z):
            kinds.append(np.full(len(x), kind, np.int32))
            a.append(x)
            b.append(y)
            t.append(np.full(len(x), z, np.int64))

        def close():
            nonlocal part, tile
            fps = np.concatenate(part) if len(part) > 1 else part[0]
            if tile:
                put(1, np.full(len(fps), key, np.int64), fps, tile)
            elif len(fps) > 1:
                put(0, *_forest(fps, radius), 0)
            part, tile = [], 0

        def flush():
            cols = [np.concatenate(c) if c else np.zeros(0, d)
                    for c, d in ((kinds, np.int32), (a, np.int64), (b, np.int64), (t, np.int64))]
            for c in (kinds, a, b, t):
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "a", "b", "tile"])

        for batch in batches:
            k = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy()
            if not len(k):
                continue
            cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
            lo = np.concatenate(([0], cuts))
            hi = np.concatenate((cuts, [len(k)]))
            # inner groups of one member make no link
            keep = (hi - lo > 1) | (lo == 0) | (hi == len(k))
            for s, e in zip(lo[keep].tolist(), hi[keep].tolist()):
                if part and k[s] != key:
                    close()
                key = k[s]
                part.append(fp[s:e])
                while limit and sum(map(len, part)) > limit:       # hot: put out tile by tile
                    fps = np.concatenate(part)
                    put(1, np.full(limit, key, np.int64), fps[:limit], tile)
                    part, tile = [fps[limit:]], tile + 1
            yield flush()
        if part:
            close()
        yield flush()
    return run


def links(fps: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly
    what pairs within ``radius`` bits connect."""
    schema = "kind int, a long, b long, tile long"
    table = F.array(*[F.xxhash64(F.lit(v), F.col("fp").bitwiseAND(F.lit(m)))
                      for v, m in enumerate(covering_masks(radius))])
    buckets = fps.select(F.explode(table).alias("bucket"), "fp")
    found = scratch.save(buckets.repartition("bucket").sortWithinPartitions("bucket", "fp")
                         .mapInArrow(_bucket_links(radius, BUCKET), schema))
    edges = found.where("kind = 0").select("a", "b")
    hot = found.where("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("fp"), "tile")
    tiles = hot.groupBy("bucket").agg((F.max("tile") + 1).alias("n"))
    pairs = (hot.join(tiles, "bucket").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
             .select(F.xxhash64("bucket", F.least("tile", "other"), F.greatest("tile", "other")).alias("bucket"), "fp"))
    more = (pairs.distinct().repartition("bucket").sortWithinPartitions("bucket", "fp")
            .mapInArrow(_bucket_links(radius, None), schema).select("a", "b"))
    return edges.union(more)


def rooted(fps: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """``fps`` (distinct fp, other columns) with the root fingerprint of each."""
    roots = connected_components(links(fps.select("fp"), radius, scratch))
    return fps.join(roots, fps["fp"] == roots["node"], "left").select(
        *[fps[c] for c in fps.columns], F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id of all documents reachable by links of
    ``radius`` or fewer differing bits. Null or empty texts have fingerprint
    zero and link like any other. Rows with a null doc_id take part; they name
    a component only by its other members (null if there is none). Repeated
    rows are repeated in the result; an empty table gives none."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, shingle))
    fps = scratch.save(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    of = scratch.save(rooted(fps, radius, scratch))
    low = of.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    named = of.join(low, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    return (rows.join(named, F.col("fp") == F.col("f"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def op4(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, shingle=4, radius=4)


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with exactly one row of each group: the smallest doc_id (null
    last), then the smallest hash of its text. Rows are told apart by doc_id
    and text, so rows of other groups with the same or no id stay."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.save(fingerprints(docs, shingle, hashed=True))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    fps = scratch.save(rows.groupBy("fp").agg(first.alias("first")))
    kept = scratch.save(rooted(fps, radius, scratch).groupBy("root").agg(F.min("first").alias("first"))
                        .select(F.col("first.doc_id").alias("__kept"), F.col("first.text_hash").alias("__text")))
    cols = docs.columns
    return (docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.xxhash64("text") == F.col("__text")))
            .dropDuplicates(["__kept", "__text"]).select(*cols))
