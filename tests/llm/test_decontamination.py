import random

import numpy as np

from ledgerline.llm import decontamination as dc
from llm_data import ODD, clashing, documents


def words(r, n, common=0.4):
    return [r.choice(("the", "of", "and", "to")) if r.random() < common else f"w{r.randrange(20000)}" for _ in range(n)]


def edited(r, item, k):
    w = list(item)
    for _ in range(k):
        i = r.randrange(len(w))
        what = r.randrange(3)
        if what == 0:
            w[i] = f"n{r.randrange(9999)}"
        elif what == 1 and len(w) > 1:
            del w[i]
        else:
            w.insert(i, f"n{r.randrange(9999)}")
    return w


def best(item, text):
    """Least word edits to a passage, by the textbook recurrence."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_exact_edits():
    r = random.Random(3)
    for _ in range(200):
        a = np.array([r.randrange(4) for _ in range(r.randrange(1, 9))])
        b = np.array([r.randrange(4) for _ in range(r.randrange(14))], np.int64)
        edits, s, e = dc.edit_passage(a, b)
        assert edits == best(a.tolist(), b.tolist())
        assert best(a.tolist(), b[s:e].tolist()) == edits


def test_recall_and_clean(spark):
    r = random.Random(11)
    items = [words(r, r.randrange(12, 60)) for _ in range(60)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    texts, held = [], set()
    for i in range(300):
        body = words(r, 250)
        if i % 2:
            item = r.randrange(60)
            k = r.randrange(int(0.2 * len(items[item])) + 1)
            at = r.randrange(250)
            body[at:at] = edited(r, items[item], k)
            held.add((i, item))
        texts.append(" ".join(body))
    got = {(x.doc_id, x.item_id) for x in dc.op9(documents(spark, texts), bench).collect()}
    assert got <= held and len(got) >= 0.95 * len(held)
    exact = documents(spark, [" ".join(words(r, r.randrange(40)) + w + words(r, r.randrange(40))) for w in items])
    assert {(x.doc_id, x.item_id, x.edits) for x in dc.op9(exact, bench).collect()} == {(i, i, 0) for i in range(60)}


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(dc, "ITEM_BLOCK", 2)
    items = [(1, "one"), (2, None), (3, ""), (4, "..."), (5, "A b, c d e f g!"), (5, "A b, c d e f g!"), (None, "long word")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(documents(spark, ODD))
    got = {(x.doc_id, x.item_id) for x in dc.op9(df, bench).collect()}
    assert got == {(3, 1), (4, 1), (5, 5), (6, 5), (8, None)}
    kept = dc.keep_uncontaminated(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 7] and kept.columns == df.columns
    assert dc.op9(df.limit(0), bench).count() == 0 and dc.op9(df, bench.limit(0)).count() == 0
    assert dc.keep_uncontaminated(df, bench.limit(0)).count() == len(ODD)


def test_edits_at_the_limit():
    """Runs of replaced words and spread deletions, at every alignment."""
    r = random.Random(23)
    for n in (20, 40, 100):
        k = n // 5
        items = [[f"w{r.randrange(30000)}" for _ in range(n)] for _ in range(20)]
        index = dc.Index([(i, " ".join(w)) for i, w in enumerate(items)])
        for at in ((n - k) // 2, None):
            texts, held = [], []
            for j in range(160):
                w = list(items[j % 20])
                if at is not None:
                    w[at:at + k] = [f"n{r.randrange(9999)}" for _ in range(k)]
                else:
                    for _ in range(k):
                        del w[r.randrange(len(w))]
                texts.append(" ".join([f"z{r.randrange(9999)}" for _ in range(j % 32)] + w + ["z"] * (j % 3 * 20)))
                held.append((j, j % 20))
            found = {x[:2] for x in index.hits(texts)}
            assert found <= set(held) and len(found) >= 0.98 * len(held)


def test_least_is_left_in_some_window():
    """Any edits of an item leave a window with what least() asks for."""
    r = random.Random(29)
    for _ in range(3000):
        n = r.randrange(1, 70)
        b, s, w = dc.shape(n)
        k, text = int(0.2 * n + 1e-9), list(range(1, n + 1))
        near = r.randrange(n + 1)
        for _ in range(k):
            i = min(len(text) - 1, max(0, near + r.randrange(-k, k + 1))) if r.random() < 0.7 else r.randrange(len(text))
            what = r.randrange(3)
            text[i:i + 1] = [0] if what == 0 else [] if what == 1 else [0, text[i]]
        before = r.randrange(2 * s)
        text = [0] * before + text + [0] * r.choice((0, w))
        starts = [*range(0, len(text) - w + 1, s), len(text) - w]
        words, pairs = dc.least(n)
        assert any(sum(x > 0 for x in text[a:a + w]) >= words
                   and sum(x > 0 and y == x + 1 for x, y in zip(text[a:a + w], text[a + 1:a + w])) >= pairs
                   for a in starts)


def test_repeated_words_make_no_pairs():
    """Items and texts of one word each: every window has every key."""
    import time
    index = dc.Index([(i, f"w{i % 5} " * 20) for i in range(200)])
    t = time.perf_counter()
    got = index.hits([f"w{n} " * 5_000 for n in range(5)] + ["w1 " * 300 + "x y z " + "w1 " * 300])
    assert time.perf_counter() - t < 20
    assert sorted((r, i) for r, i, *_ in got) == sorted(
        [(n, i) for n in range(5) for i in range(200) if i % 5 == n] + [(5, i) for i in range(200) if i % 5 == 1])
    assert all(x[2] == 0 for x in got)
