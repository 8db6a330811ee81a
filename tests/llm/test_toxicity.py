import random
import zlib

from pyspark.sql import functions as F

from ledgerline.llm import toxicity
from llm_data import ODD, clashing, documents

SF = "/root/testdata/sf0.1"
LABEL = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op10(docs, labels).join(labels, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic]
    false = [r.predicted for r in rows if not r.toxic]
    assert sum(caught) / len(caught) > 0.8 and sum(false) / len(false) < 0.01
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out and 0 <= r.score <= 1 for r in rows)


def test_segments_match_brute_force():
    r = random.Random(2)
    terms = {"p": 1.1, "q": 2.3, "t": 0.6}
    for _ in range(300):
        words = [r.choice("pqtxxxxxx") for _ in range(r.randrange(25))]
        score = [terms.get(w, -toxicity.DRIFT) for w in words]

        def split(lo, hi):
            """Ruzzo and Tompa's recursive definition."""
            top, at = 0, None
            for a in range(lo, hi):
                for b in range(a + 1, hi + 1):
                    s = sum(score[a:b])
                    if s > top + 1e-9:
                        top, at = s, (a, b)
            return [] if at is None else split(lo, at[0]) + [at] + split(at[1], hi)
        assert [(a, b) for a, b, _ in toxicity.segments(words, terms)] == split(0, len(words))


def test_odd_rows_and_missing_labels(spark):
    df = clashing(documents(spark, ODD))
    none = spark.createDataFrame([], LABEL)
    for labels in (none, spark.createDataFrame([(None, 1, 1), (3, None, None), (5, 1, 0)], LABEL)):
        rows = toxicity.op10(df, labels).collect()
        assert len(rows) == len(ODD) and all(r.predicted == 0 for r in rows)
        assert toxicity.keep_clean(df, labels).count() == len(ODD)
    assert toxicity.op10(df.limit(0), none).count() == 0
    only_toxic = spark.createDataFrame([(i, 1, 1) for i in range(len(ODD))], LABEL)
    assert {(r.predicted, r.score < 0.5) for r in toxicity.op10(df, only_toxic).collect()} == {(0, True)}
    assert toxicity.keep_clean(df, only_toxic).count() == len(ODD)


def test_learns_and_ignores_held_out_labels(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefghij") * 2 for _ in range(60)) + (" vile filth" if i % 4 == 0 else "") for i in range(400)]
    df = documents(spark, texts)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(400)]
    true = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABEL)
    lies = spark.createDataFrame([(i, 1, int((i % 4 == 0) != held[i])) for i in range(400)], LABEL)
    a = {x.doc_id: x.score for x in toxicity.op10(df, true).collect()}
    assert a == {x.doc_id: x.score for x in toxicity.op10(df, lies).collect()}
    assert all((a[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    kept = toxicity.keep_clean(df, true)
    assert kept.where(F.col("doc_id") % 4 == 0).count() == 0 and kept.count() == 300
    p = {x.doc_id: x.passages for x in toxicity.score(df, true).collect()}
    assert len(p[0]) == 1 and (p[0][0].first, p[0][0].end) == (60, 62) and not p[1]
