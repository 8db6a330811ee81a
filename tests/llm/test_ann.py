import numpy as np

from ledgerline.llm import ann
from llm_data import clashing

SF = "/root/testdata/sf0.01"


def exact(ids, x, q, k=5):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = x @ x[ids == q][0]
    c[ids == q] = -2
    return ids[np.lexsort((ids, -c))][:k].tolist()


def test_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    e = df.toPandas()
    ids, x = e.vec_id.to_numpy(), np.stack(e.embedding).astype(float)
    got = ann.op3(df).toPandas()
    hit = sum(len(set(exact(ids, x, q)) & set(g.vec_id)) for q, g in got.groupby("query_id"))
    assert hit >= 0.9 * 5 * (ids % 50 == 0).sum()
    assert got.groupby("query_id")["rank"].apply(list).map(lambda r: r == [1, 2, 3, 4, 5]).all()
    for _, r in got.head(20).iterrows():
        a, b = x[ids == r.query_id][0], x[ids == r.vec_id][0]
        assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_pigeonhole_finds_every_code():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    codes[:500] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    index = ann.MultiIndex(codes)
    for r in (0, 3, 7, 8, 13, 27, 64):
        for q in codes[[0, 700, 2999]]:
            assert index.within(q, r).tolist() == np.flatnonzero(np.bitwise_count(codes ^ q) <= r).tolist()


def test_blocks_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BASE_BLOCK", 40)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 16))
    v[100:130] = v[0]                                            # ties
    rows = [(i, [float(a) for a in x]) for i, x in enumerate(v)]
    rows += [rows[0], (None, rows[3][1]), (300, None), (350, [0.0] * 16), (400, [None] * 16), (450, [float("nan")] * 16),
             (500, [float("inf")] * 16), (550, []), (600, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.op3(clashing(df)).toPandas()
    assert sorted(got.query_id.unique()) == [0, 50, 100, 150]
    # row 0 occurs twice: each copy is a query, and a candidate of the other
    for _, g in got[got.query_id == 0].groupby("query_row"):
        assert g.sort_values("rank").vec_id.tolist() == [0, 100, 101, 102, 103]
    assert got[got.query_id == 0].query_row.nunique() == 2
    assert got[got.query_id == 100].sort_values("rank").vec_id.tolist() == [0, 0, 101, 102, 103]
    assert ann.op3(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert ann.op3(few).count() == 2
    assert ann.op3(spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>")).count() == 0


def test_repeated_ids_and_large_components(spark):
    """Every row is a candidate; no finite vector overflows."""
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 0.0]), (3, [0.0, 1.0]), (3, [2.0, 0.0]), (4, [1e200, 1e200]), (5, [1e-200, 2e-200]), (6, [-1e308, 1e-300])]
    got = ann.op3(spark.createDataFrame(rows, schema)).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 6)) for r in got] == [
        (3, 1.0), (4, round(0.5 ** 0.5, 6)), (5, round(0.2 ** 0.5, 6)), (3, 0.0), (6, -1.0)]
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 12)) * 10.0 ** rng.integers(-150, 150, (300, 1))
    ids = rng.integers(0, 120, 300)                                # two or three rows an id
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], schema)
    u = ann.scaled(v)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    want = []
    for q in np.flatnonzero(ids % 50 == 0):
        c = u @ u[q]
        c[q] = -2
        want.append((int(ids[q]), tuple(np.round(np.sort(c)[::-1][:5], 9))))
    got = ann.op3(df).toPandas().sort_values("rank")
    found = [(int(g.query_id.iloc[0]), tuple(np.round(g.score, 9))) for _, g in got.groupby("query_row")]
    hit = sum(len(set(a[1]) & set(b[1])) for a, b in zip(sorted(found), sorted(want)))
    assert len(found) == len(want) and hit >= 0.9 * 5 * len(want)
