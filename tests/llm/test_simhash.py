import random

import numpy as np
import pytest
import xxhash

from ledgerline.llm import simhash
from ledgerline.llm.components import connected_components
from llm_data import ODD, clashing, documents


def reference(text):
    """The contract, word for word."""
    import re
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(ids, fps, radius=4):
    x = np.array(fps, np.uint64)
    comp = list(range(len(x)))
    while True:
        new = [min([comp[j] for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= radius)], key=lambda j: ids[j]) for i in range(len(x))]
        if new == comp:
            return [ids[c] for c in comp]
        comp = new


def near_texts(seed, n=150):
    r = random.Random(seed)
    base = [[r.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(r.randrange(99)) for _ in range(200)]
            for _ in range(6)]
    out = []
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = str(r.randrange(999))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("limit", [2048, 3])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BUCKET", limit)
    texts = near_texts(5) + ODD[:-1] + ["X Y\x0bZ W v", "x y\x0bz w v"]
    ids = [3 * i % 1000 for i in range(len(texts))]
    rows = {r.doc_id: r for r in simhash.op4(clashing(documents(spark, texts, ids))).collect()}
    want = [reference(t) for t in texts]
    assert [rows[i].fingerprint for i in ids] == [f"{f:016x}" for f in want]
    assert [rows[i].component_id for i in ids] == brute(ids, want)


def test_covering_masks():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    r = random.Random(0)
    for _ in range(2000):
        diff = sum(1 << b for b in r.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def test_long_text_and_empty(spark):
    t = "some words here and there " * 40_000
    df = documents(spark, [t, t, None], [7, 4, None])
    got = {(r.doc_id, r.component_id) for r in simhash.op4(df).collect()}
    assert got == {(7, 4), (4, 4), (None, None)}
    assert simhash.op4(df.limit(0)).count() == 0


def test_keep_one(spark):
    df = documents(spark, ["a b c", "a b c", "x y z", "a b c"], [2, 1, 5, 1])
    kept = simhash.keep_one(clashing(df))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and "fp" in kept.columns


def test_keep_one_with_null_and_shared_ids(spark):
    rows = [("a b c", None), ("x y z", None), ("x y z", None), (None, None),          # groups of null ids only
            ("p q r", None), ("p q r", 3), ("s t u", 5), ("k l m", 3), ("k l m", 5), ("s t u", 5)]
    df = documents(spark, [t for t, _ in rows], [i for _, i in rows])
    kept = [(r.text, r.doc_id) for r in simhash.keep_one(clashing(df)).collect()]
    assert sorted(kept, key=str) == sorted([("a b c", None), ("x y z", None), (None, None), ("p q r", 3),
                                            ("s t u", 5), ("k l m", 3)], key=str)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (100, 100), (100, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
