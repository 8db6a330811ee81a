import hashlib
import random

import pytest

from ledgerline.llm import suffixes
from llm_data import ODD, clashing, documents


def brute(rows):
    """rows: (doc_id, text), distinct. Result by (doc_id, text)."""
    docs = sorted(((-(1 << 63) if i is None else i), (t or "").encode()) for i, t in rows)
    key = {b: suffixes.text_key(b) for _, b in docs}
    first = {}
    for i, b in docs:
        for a in range(len(b) - 99):
            k = b[a:a + 100]
            first[k] = min(first.get(k, (i, key[b], a)), (i, key[b], a))
    out = {}
    for i, b in docs:
        gone = bytearray(len(b))
        for a in range(len(b) - 99):
            if first[b[a:a + 100]] < (i, key[b], a):
                gone[a:a + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i, b] = (len(b), sum(gone), gone.count(b"\0\1") + (gone[:1] == b"\1"), hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, df=None):
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows]) if df is None else df
    got = sorted(((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.op1(df).collect()))
    want = brute(set(rows))
    assert got == sorted(want[-(1 << 63) if i is None else i, (t or "").encode()] for i, t in rows)


def corpus(seed, n=60):
    r = random.Random(seed)
    passage = ["".join(r.choice("abcdé ") for _ in range(r.choice((90, 99, 100, 101, 150, 400)))) for _ in range(8)]
    out = []
    for i in range(n):
        parts = [r.choice(passage) if r.random() < 0.5 else "".join(r.choice("xyz ") for _ in range(r.randrange(150)))
                 for _ in range(r.randrange(5))]
        out.append((i, "".join(parts)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_hot_buckets_and_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 5)
    monkeypatch.setattr(suffixes, "GROUP", 700)
    check(spark, corpus(3, 40))


def test_ranked_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SMALL", 2)
    check(spark, corpus(4))


def test_periodic_and_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD[:-1])] + [(20, "ab" * 300), (21, "a" * 250), (22, "ab" * 100), (None, "a" * 120)]
    check(spark, rows)
    check(spark, [(1, "q" * 99 + "r" * 200)] * 3 + [(2, "q" * 99 + "r" * 200)])


def test_empty_and_clashing(spark):
    df = documents(spark, ["w" * 300])
    assert suffixes.op1(df.limit(0)).count() == 0
    check(spark, [(0, "w" * 300)], clashing(df))


def test_many_texts_under_one_id(spark):
    """Texts that share an id (null ids too) keep their own bytes."""
    r = random.Random(9)
    line = "".join(r.choice("abcdef ") for _ in range(130))
    texts = ["".join(r.choice("uvwxyz ") for _ in range(r.randrange(100, 200))) + (line if n % 2 else "") for n in range(400)]
    check(spark, [(None if n % 3 else 7, t) for n, t in enumerate(texts)])
    lone = [(None, t) for t in texts[::2]]
    got = suffixes.op1(documents(spark, [t for _, t in lone], [None] * len(lone)))
    assert got.where("n_removed > 0").count() == 0


def test_a_common_line_leaves_its_task(spark, monkeypatch):
    """Equal runs are settled where they are read; a common line's anchors, whose
    runs differ at its edge, are found frequent and dealt out by run."""
    r = random.Random(2)
    line = "".join(r.choice("abcdef ") for _ in range(400))
    rows = [(n, "".join(r.choice("uvwxyz ") for _ in range(120)) + line) for n in range(300)]
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows]).coalesce(1)
    s = suffixes.sample(df).toPandas()
    assert s.h.isna().sum() > 300 and not s[s.h.notna()].duplicated(["h", "c"]).any()
    monkeypatch.setattr(suffixes, "TRACKED", 64)
    monkeypatch.setattr(suffixes, "FREQUENT", 10)
    hot = suffixes.frequent(suffixes.sample(df).where("h is not null").select("h"), "h", 64, 10).collect()
    assert len(hot) >= 1
    check(spark, rows)
    check(spark, corpus(5))
