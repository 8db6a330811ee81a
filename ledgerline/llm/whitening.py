"""Embedding whitening with principal components by contour integration.

Each entry c of a vector becomes the integer x = floor(64 c) + 1000000. Spark
sums x per dimension exactly, then the products of centred entries (one d x d
partial matrix a task, merged by a grouped sum). The covariance's spectrum is cut
into slices by inertia counts, each slice is solved as a Spark task
(:mod:`.feast`), and the number found must be the number counted. Vectors are
projected on the components and divided by the root of their eigenvalues, and
the covariance of the result is measured the same way. Only sums over all rows
with d or d x d numbers reach the driver.

Vectors that are null, empty or hold null or non-finite entries are left out.
Vectors of another length than most (of equally frequent lengths, the longer) are
left out too. Entries beyond 2^34 in size count as 2^34. A component is returned
if its eigenvalue is above 1e-10 of the largest, as no others can be whitened:
fewer than 32 for fewer dimensions or dependent vectors, none (no rows) for a
single vector or equal ones. ``deviation`` is null where it exceeds a long.
Repeated rows and null ids are rows like any other; other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import feast
from .common import Scratch

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Largest |floor(64 c)|, so that a batch's sums stay exact.
LIMIT = 1 << 40
#: Smallest eigenvalue of a component, as a share of the largest.
RANK = 1e-10


@dataclass
class Fit:
    """n vectors of d entries, their exact sums, the components (d x k, unit
    columns), their eigenvalues and the covariance's trace."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def d(self) -> int:
        return len(self.sums)


def usable(col: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> (row indices, matrix of x as int64) of a batch's usable vectors."""
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64)
    parent = np.repeat(np.arange(len(col)), sizes)
    bad = np.bincount(parent[~np.isfinite(values)], minlength=len(col)) > 0
    start = np.concatenate([[0], sizes.cumsum()])
    out = {}
    for d in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero((sizes == d) & ~bad)
        if len(rows):
            c = values[start[rows][:, None] + np.arange(d)]
            with np.errstate(over="ignore"):
                out[int(d)] = rows, np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + SHIFT
    return out


def entry_sums(vectors: DataFrame, vec: str) -> tuple[int, list[int]]:
    """(n, exact sum of x per dimension) of the vectors of the commonest length."""
    def run(batches):
        total = {}
        for batch in batches:
            for d, (rows, x) in usable(batch.column(vec)).items():
                n, s = total.get(d, (0, [0] * d))
                total[d] = n + len(rows), [a + int(b) for a, b in zip(s, x.sum(axis=0))]
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_pydict({
                "d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
                "n": pa.array([n] * d, pa.int64()), "s": pa.array([str(v) for v in s], pa.string())})
    part = vectors.select(vec).mapInArrow(run, "d int, i int, n long, s string")
    # a few lengths at most in practice; the commonest is taken before its d sums are read
    per = part.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    top = per.where("i = 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not top:
        return 0, []
    rows = per.where(F.col("d") == top[0].d).orderBy("i").collect()
    return rows[0].n, [int(r.s) for r in rows]


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The means as the nearest integers and the rest, which is under 1 and is
    rounded once: subtracting one after the other loses no digits."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole)])


def merged(part: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' upper triangles (i, values from column i on)."""
    cells = part.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((size, size))
    for r in cells.collect():                              # size * (size + 1) / 2 rows
        out[r.i, r.i + r.j] = out[r.i + r.j, r.i] = r.x
    return out


def triangle(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"i": pa.array(range(len(m)), pa.int32()),
                                       "v": pa.array([m[i, i:].tolist() for i in range(len(m))])})


def covariance(vectors: DataFrame, vec: str, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of x, divisor n, centred before multiplying."""
    d = len(sums)
    whole, rest = centre(n, sums)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            _, x = usable(batch.column(vec)).get(d, (None, None))
            if x is not None:
                y = (x - whole) - rest
                total += y.T @ y
        yield triangle(total)
    return merged(vectors.select(vec).mapInArrow(run, "i int, v array<double>"), d) / n


def components(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v`` above the rank's bound, falling, and
    their unit eigenvectors as columns, the largest entry positive. Every slice
    of the spectrum is a task of its own."""
    scale = float(np.abs(v).sum(axis=1).max(initial=0.0))
    cut = feast.slices(v, k, RANK * scale)
    if not cut:
        return np.zeros(0), np.zeros((len(v), 0))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                e, u = feast.eigenpairs(v, r["lo"], r["hi"], r["count"])
                yield pa.RecordBatch.from_pydict({"e": pa.array(e), "u": pa.array(u.T.tolist(), pa.list_(pa.float64()))})
    todo = spark.createDataFrame(cut, "lo double, hi double, count int").repartition(len(cut))
    found = sorted(todo.mapInArrow(run, "e double, u array<double>").collect(), key=lambda r: -r.e)
    if len(found) != sum(c for _, _, c in cut):
        raise ArithmeticError("the slices hold another number of eigenvalues than their inertia counts")
    u = np.array([r.u for r in found[:k]]).T
    sign = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return np.array([r.e for r in found[:k]]), u * sign


def fit(vectors: DataFrame, k: int = COMPONENTS, vec: str = "embedding") -> Fit:
    n, sums = entry_sums(vectors, vec)
    if not n:
        return Fit(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    v = covariance(vectors, vec, n, sums)
    e, u = components(vectors.sparkSession, v, k)
    return Fit(n, sums, u, e, float(np.trace(v)))


def deviations(x: np.ndarray, n: int, whole: np.ndarray, sums: list[int]) -> list[int | None]:
    """Exact sums over dimensions of (n x - S)^2, None where beyond a long."""
    left = [n * int(w) - s for w, s in zip(whole, sums)]              # n x - S = n (x - whole) + left
    y = x - whole
    most = max(n * int(np.abs(y[:, i]).max(initial=0)) + abs(r) for i, r in enumerate(left))
    if most * most * len(left) < 1 << 63:
        z = n * y + np.array(left, np.int64)
        return (z * z).sum(axis=1).tolist()
    exact = [sum((n * int(a) + r) ** 2 for a, r in zip(row, left)) for row in y]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, model: Fit, ident: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(ident, deviation, whitened) of every usable vector; ``whitened`` has one
    entry per component."""
    whole, rest = centre(model.n, model.sums) if model.n else (np.zeros(0, np.int64), np.zeros(0))
    turn = model.components / np.sqrt(model.values)

    def run(batches):
        for batch in batches:
            rows, x = usable(batch.column(vec)).get(model.d, (None, None))
            if x is None:
                continue
            w = ((x - whole) - rest) @ turn
            offsets = pa.array(np.arange(len(rows) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(ident).take(pa.array(rows)), pa.array(deviations(x, model.n, whole, model.sums), pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=[ident, "deviation", "whitened"])
    kind = vectors.schema[ident].dataType.simpleString()
    return vectors.select(ident, vec).mapInArrow(run, f"`{ident}` {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the whitened covariance minus the identity."""
    sums = whitened.select(F.posexplode("whitened").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s"))
    mean = np.zeros(k)
    for r in sums.collect():                                          # k rows
        mean[r.i] = r.s / n

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            y = pc.list_flatten(batch.column("whitened")).to_numpy(zero_copy_only=False).reshape(-1, k) - mean
            total += y.T @ y
        yield triangle(total)
    got = merged(whitened.select("whitened").mapInArrow(run, "i int, v array<double>"), k) / n
    return float(np.abs(got - np.eye(k)).max())


def op11(vectors: DataFrame) -> DataFrame:
    src = vectors.select("vec_id", "embedding")
    model = fit(src)
    k = len(model.values)
    rows = Scratch(src.sparkSession, "whitening").save(whiten(src, model)) if k else whiten(src.limit(0), model)
    error = identity_error(rows, model.n, k) if k else 0.0
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if k else F.array(F.lit(0.0))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(share, F.col("i") + 1).alias("explained"), F.lit(error).alias("identity_error"))
