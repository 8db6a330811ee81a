"""Approximate nearest neighbours by multi-index hashing.

Codes: the signs of a rotation learned by iterative quantisation (Gong et al.)
on a bounded sample. A code is split into ``PARTS`` substrings, each with an
index of its own. By the pigeonhole principle a code within r bits has some
substring within its share of r, so probing each index at that share retrieves
every code within r. Those are reranked by exact cosine on the original
vectors. r is the smallest radius that holds ``RECALL`` of the true neighbours
of the sample, which are farther away than those in all rows.

All rows are indexed, in blocks; the queries are a stated set, met with every
block in blocks of their own, and each meeting gives k rows per query at most.
Both kinds of block are of one size, so a vector is sent once per block of
queries and a query once per block of vectors.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

BITS, PARTS = 64, 8
#: Vectors that the rotation and the radius are learned from (in hash order).
SAMPLE, SAMPLE_QUERIES, RECALL = 4096, 512, 0.97
BASE_BLOCK, QUERY_BLOCK = 8192, 8192


def learn(sample: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, int]:
    """(projection, radius) from unit vectors."""
    rng = np.random.default_rng(seed)
    bits = min(BITS, sample.shape[1])
    _, _, axes = np.linalg.svd(sample, full_matrices=False)
    p = sample @ axes[:bits].T
    if p.shape[1] < bits:                                # fewer rows than bits
        p = np.pad(p, ((0, 0), (0, bits - p.shape[1])))
    axes = np.vstack([axes[:bits], np.zeros((max(0, bits - len(axes)), sample.shape[1]))])
    r = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(30):
        u, _, v = np.linalg.svd(np.where(p @ r > 0, 1.0, -1.0).T @ p)
        r = (u @ v).T
    proj = axes.T @ r
    codes = encode(sample, proj)
    q = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    cos = sample[q] @ sample.T
    cos[np.arange(len(q)), q] = -2
    near = np.argsort(-cos, axis=1)[:, :k]
    apart = np.bitwise_count(codes[q][:, None] ^ codes[near])
    return proj, int(np.ceil(np.quantile(apart, RECALL)))


def encode(unit: np.ndarray, proj: np.ndarray) -> np.ndarray:
    bits = unit @ proj > 0
    bits = np.pad(bits, ((0, 0), (0, BITS - bits.shape[1])))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


#: All 8-bit masks by weight.
_MASKS = [np.array([sum(1 << b for b in c) for c in combinations(range(8), w)], np.uint8) for w in range(9)]


class MultiIndex:
    """Substring tables over a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = codes.view(np.uint8).reshape(-1, PARTS)
        self.order = [np.argsort(self.parts[:, j], kind="stable") for j in range(PARTS)]
        self.begin = [np.searchsorted(self.parts[self.order[j], j], np.arange(257)) for j in range(PARTS)]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Every position whose code is within ``radius`` bits of ``code``.
        With radius = PARTS * a + b, some of the first b + 1 substrings is
        within a bits or some other within a - 1."""
        a, b = divmod(radius, PARTS)
        mine = np.array([code], np.uint64).view(np.uint8)
        seen = np.zeros(len(self.codes), bool)
        for j in range(PARTS):
            reach = min(a if j <= b else a - 1, 8)
            for w in range(reach + 1):
                for v in (_MASKS[w] ^ mine[j]).tolist():
                    seen[self.order[j][self.begin[j][v]:self.begin[j][v + 1]]] = True
        cand = np.flatnonzero(seen)
        return cand[np.bitwise_count(self.codes[cand] ^ code) <= radius]


def scaled(v: np.ndarray) -> np.ndarray:
    """Rows by the power of two of their largest component: no digit changes, and
    no square is too large or too small for a double."""
    _, e = np.frexp(np.abs(v).max(axis=1))
    return np.ldexp(v, -e[:, None])


def _search(proj, radius: int, k: int):
    def run(key, q: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(q) and len(base):
            v = scaled(np.stack(base["base_v"].to_numpy()).astype(np.float64))
            ids, rows = base["base_id"].to_numpy(), base["base_row"].to_numpy()
            norm = np.sqrt((v * v).sum(1))
            index = MultiIndex(encode(v / norm[:, None], proj))
            asked = scaled(np.stack(q["v"].to_numpy()).astype(np.float64))
            for qrow, qid, x in zip(q["row"].tolist(), q["id"].tolist(), asked):
                n = np.sqrt((x * x).sum())
                code = encode((x / n)[None], proj)[0]
                r = radius
                while True:
                    cand = index.within(code, r)
                    cand = cand[rows[cand] != qrow]
                    if len(cand) >= k or r >= BITS:
                        break
                    r = min(BITS, r + 4)                 # too few: widen until k are found
                cos = (v[cand] * x).sum(1) / (norm[cand] * n)
                top = np.lexsort((ids[cand], -cos))[:k]
                out["query_row"].extend([qrow] * len(top))
                out["query_id"].extend([qid] * len(top))
                out["vec_id"].extend(ids[cand][top].tolist())
                out["score"].extend(cos[top].tolist())
        return pd.DataFrame(out).astype({"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def nearest(vectors: DataFrame, queries, k: int = 5, vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, query_row: the k nearest found of every row
    for which the column expression ``queries`` (over vec_id) holds.

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows without an id. Rows that
    repeat an id are rows of their own, as candidates and as queries (told apart
    by ``query_row``): only the query's own row is left out. Fewer than k other
    rows: all of them. Vectors of any finite size are compared without overflow.
    An empty table gives no rows."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    v = F.col(vec).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
            .where("id is not null and v is not null and size(v) > 0").where(fine & F.exists("v", lambda x: x != 0))
            .withColumn("row", F.monotonically_increasing_id()))
    rows = scratch.save(rows)
    schema = "query_row long, query_id long, vec_id long, score double"
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_row long")
    rows = rows.where(F.size("v") == size["n"])
    sample = scaled(np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("v").collect()]))
    proj, radius = learn(sample / np.sqrt((sample ** 2).sum(1))[:, None], k)
    q = rows.where(queries(F.col("id")))
    nb = max(1, -(-size["count"] // BASE_BLOCK))
    nq = max(1, -(-q.count() // QUERY_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # columns of its own, as both sides are the same table
    base = (rows.select(F.col("id").alias("base_id"), F.col("v").alias("base_v"), F.col("row").alias("base_row"),
                        block(nb).alias("bb")).withColumn("qb", every(nq)))
    asked = q.withColumn("qb", block(nq)).withColumn("bb", every(nb))
    found = (asked.groupBy("qb", "bb").cogroup(base.groupBy("qb", "bb"))
             .applyInPandas(_search(proj, radius, k), schema))
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "query_row"))


def op3(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, lambda i: i % 50 == 0)
