import math

import numpy as np
import pytest

from ledgerline.llm import feast, whitening
from llm_data import clashing

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def whole(c):
    return math.floor(64 * c) + 1_000_000


def exact(rows):
    """(ids, x as Python integers, deviations, covariance) by plain arithmetic."""
    x = [[whole(float(c)) for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    dev = [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x]
    y = np.array([[(n * r[i] - s[i]) / n for i in range(d)] for r in x])
    return n, dev, y, y.T @ y / n


def check(got, rows, k):
    """``got``: pandas result of op11 against numpy's eigendecomposition."""
    n, dev, y, v = exact(rows)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    want = y @ u / np.sqrt(e)
    assert len(got) == len(rows) * k and set(got.n) == {n}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    wide = wide * np.sign((wide * want).sum(axis=0))
    assert np.abs(wide - want).max() < 1e-7
    one = got.drop_duplicates("vec_id").set_index("vec_id")
    assert [int(one.deviation[i]) for i, _ in rows] == dev
    share = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.allclose(share, e / np.trace(v), rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert len({i for i, _ in rows}) == len(rows)
    check(whitening.op11(df).toPandas(), rows, 32)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(60, 5)))]
    good += [(100 + i, good[0][1]) for i in range(40)]                        # a third is one vector
    odd = [(900, None), (901, []), (902, [None] * 5), (903, [float("nan")] * 5), (904, [1.0, 2.0, 3.0, 4.0, float("inf")]),
           (905, [1.0] * 3), (906, [1.0, None, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(good + odd, SCHEMA).repartition(4)
    got = whitening.op11(clashing(df)).toPandas()
    check(got, good, 5)
    assert got.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.op11(df.limit(0)).count() == 0
    assert whitening.op11(df.where("vec_id >= 900 and vec_id <> 905")).count() == 0
    assert whitening.op11(df.where("vec_id = 3")).count() == 0                # one vector has no spread
    assert whitening.op11(spark.createDataFrame([good[0]] * 5, SCHEMA)).count() == 0
    twice = spark.createDataFrame(good + [(None, good[1][1]), good[2]], SCHEMA)
    assert whitening.op11(twice).count() == 102 * 5
    few = whitening.op11(spark.createDataFrame(good[:3], SCHEMA)).toPandas()   # rank 2
    assert sorted(set(few.component)) == [1, 2] and few.identity_error.max() < 1e-9


def test_huge_entries(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.5, -3e9]), (3, [0.0, 7.0])]
    got = whitening.op11(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(got) == 8 and np.isfinite(got.whitened).all() and got.identity_error.max() < 1e-4
    assert got[got.vec_id == 0].deviation.isna().all()                        # beyond a long


def test_deviation_is_exact_beyond_64_bits():
    x = np.array([[10 ** 9, 5], [7, 5]], np.int64)
    whole_, sums = np.array([3, 5]), [10 ** 10 + 1, 11]
    want = [(10 ** 6 * int(a) - sums[0]) ** 2 + (10 ** 6 * int(b) - sums[1]) ** 2 for a, b in x]
    assert whitening.deviations(x, 10 ** 6, whole_, sums) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("seed", range(6))
def test_feast_finds_every_eigenvalue(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(2, 70))
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    e = np.sort(rng.exponential(size=d))[::-1]
    if seed % 2:
        e[: d // 3] = e[0]                                                    # a multiple eigenvalue
        e[d // 2:] = 0                                                        # and a null space
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    true = np.linalg.eigvalsh(v)
    for shift in (-1.0, 0.3, 1.0, 50.0):
        assert feast.below(v, shift) == (true < shift).sum()
    k = min(32, int((true > 1e-9).sum()))
    cut = feast.slices(v, k, 1e-10 * np.abs(v).sum(axis=1).max())
    pairs = [feast.eigenpairs(v, *s) for s in cut]
    found = np.concatenate([p[0] for p in pairs])
    vectors = np.hstack([p[1] for p in pairs])
    assert len(found) >= k and np.allclose(found[:k], true[::-1][:k], atol=1e-12 * max(1, true[-1]))
    assert np.abs(v @ vectors - vectors * found).max() < 1e-11
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-9


def test_a_missed_eigenvalue_is_an_error():
    v = np.diag([1.0, 2.0, 3.0, 9.0])
    with pytest.raises(ArithmeticError):
        feast.eigenpairs(v, 0.5, 4.0, 2)                                      # the interval holds three
