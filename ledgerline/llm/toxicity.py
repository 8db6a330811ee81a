"""Toxicity by maximum-scoring segments of token log-odds.

Model: each token's log-odds between toxic and clean training documents, with
an informative Dirichlet prior proportional to the token's document frequency
in the whole corpus (Monroe, Colaresi and Quinn 2008). Tokens whose log-odds
are significant score them; all others cost a small drift, so the expected
score of clean text is negative.

Scan: the linear-time algorithm of Ruzzo and Tompa finds every maximal
scoring segment of a text. Extreme-value theory (Karlin and Altschul) turns
segment scores into significance: lambda solves sum p exp(lambda s) = 1 on the
clean token distribution, and n words make K n exp(-lambda S) segments of score
S by chance. A document's statistic is the best sum over its r strongest
segments, sum(lambda S) - r ln(K n) + ln r!; a logistic curve fitted on the
training rows maps it to (0, 1).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model learns from, at most (in hash order).
TRAIN_ROWS = 40_000
#: Distinct tokens that a task counts before it hands the counts on.
FLUSH = 200_000
STRIP = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
PRIOR, MIN_Z, MIN_ODDS, DRIFT = 50.0, 3.0, math.log(4), 0.25
K = 0.1
#: Highest score where nothing tells documents apart: none is rejected then.
UNTOLD = 0.49


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without ASCII punctuation at their ends."""
    return [t for w in (text or "").lower().split() if (t := w.strip(STRIP))]


def held_out(doc_id):
    """Whether crc32 of the id as text is 0 modulo 5 (a null id is not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of the labelled rows that may be learned from, equal texts
    once. The ids are at most ``limit`` long integers, so they are broadcast
    and no text moves but that of the sample."""
    ids = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("__toxic"))
           .orderBy(F.xxhash64("__id"), "__id").limit(limit))
    return (docs.select(F.col("doc_id").alias("__d"), F.col("text").alias("text"))
            .join(F.broadcast(ids), F.col("__d") == F.col("__id"))
            .select("text", F.col("__toxic").alias("toxic"))
            .groupBy("text").agg(F.max("toxic").alias("toxic")))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(token, toxic, n, docs): in how many rows of (text, toxic) a token
    occurs; the row with token '' counts the rows themselves."""
    def run(batches):
        counts: dict[int | None, Counter] = {}

        def out():
            rows = [(w, k, c) for k, cs in counts.items() for w, c in cs.items()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["token", "toxic", "n"])
        for b in batches:
            for text, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                c = counts.setdefault(k, Counter())
                c.update(set(tokens(text)))
                c[""] += 1
            if sum(map(len, counts.values())) > FLUSH:
                yield out()
        yield out()
    return (texts.select("text", F.col("toxic").cast("int"))
            .mapInArrow(run, "token string, toxic int, n long")
            .groupBy("token", "toxic").agg(F.sum("n").alias("n")))


def fit_terms(docs: DataFrame, train: DataFrame) -> dict:
    """The scoring model: every significant term {token: score} (they come from
    the bounded sample), lambda, and the training base rate. Without toxic or
    without clean rows there are no terms."""
    seen = document_frequencies(train).groupBy("token").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") > 0, F.col("n"))), F.lit(0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("toxic") <= 0, F.col("n"))), F.lit(0)).alias("c"))
    seen = seen.where("token = '' or t > 1")             # a token of one toxic text proves nothing
    corpus = document_frequencies(docs.select("text", F.lit(0).alias("toxic")))
    both = seen.join(corpus.select("token", "n"), "token", "left").na.fill(0, ["n"])
    total = both.where("token = ''").first()
    nt, nc, n = (total["t"], total["c"], total["n"]) if total else (0, 0, 0)
    rate = nt / (nt + nc) if nt + nc else 0.0
    if not nt or not nc:
        return {"terms": {}, "lam": 1.0, "rate": rate}
    prior = F.greatest(F.lit(PRIOR) * F.col("n") / F.lit(float(max(n, 1))), F.lit(0.01))
    # a token of every document leaves nothing on the other side: 0.01 is the prior's floor
    odds = lambda y, of: F.log((F.col(y) + F.col("a")) / F.greatest(
        F.lit(of + PRIOR) - F.col(y) - F.col("a"), F.lit(0.01)))
    scored = (both.where("token <> ''").withColumn("a", prior)
              .withColumn("delta", odds("t", nt) - odds("c", nc))
              .withColumn("z", F.col("delta") / F.sqrt(1 / (F.col("t") + F.col("a")) + 1 / (F.col("c") + F.col("a"))))
              .where((F.col("z") >= MIN_Z) & (F.col("delta") >= MIN_ODDS)).orderBy("token"))
    rows = scored.select("token", "delta", ((F.col("c") + F.col("a")) / (nc + PRIOR)).alias("p")).collect()
    terms = {r["token"]: r["delta"] for r in rows}
    # document frequencies over-state a token's share of words, which only makes the test stricter
    p = np.array([r["p"] for r in rows]) / 100.0
    s = np.array([r["delta"] for r in rows])
    lo, hi = 1e-6, 50.0
    for _ in range(80):                                  # sum p exp(lambda s) + (1 - p) exp(-lambda drift) = 1
        mid = (lo + hi) / 2
        if (p * np.exp(np.minimum(mid * s, 500))).sum() + (1 - min(p.sum(), 1)) * math.exp(-mid * DRIFT) > 1:
            hi = mid
        else:
            lo = mid
    return {"terms": terms, "lam": lo if len(rows) else 1.0, "rate": rate}


def segments(words: list[str], terms: dict[str, float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, end, score), by Ruzzo and
    Tompa. Words without a score only lower the running total, so the scan
    steps from term to term."""
    found: list[tuple[int, int, float, float]] = []      # first, end, total before, total after
    total, at = 0.0, 0
    for i, w in enumerate(words):
        if w not in terms:
            continue
        total -= DRIFT * (i - at)
        at = i + 1
        first, before = i, total
        total += terms[w]
        after = total
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j -= 1
            if j < 0 or found[j][3] >= after:
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
        found.append((first, i + 1, before, after))
    return [(a, b, y - x) for a, b, x, y in found]


def statistic(segs, n_words: int, lam: float) -> float:
    """Best Karlin-Altschul sum over the r strongest segments; the value of an
    empty set is 0, and strong documents are above it."""
    level = math.log(max(K * n_words, 1.0)) if n_words else 0.0
    best = total = 0.0
    for r, s in enumerate(sorted((s for *_, s in segs), reverse=True), 1):
        total += lam * s - level + math.log(r)
        best = max(best, total)
    return best


def passages(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, statistic, passages (first word, end word, score, e_value) with
    an e-value of 1 or less."""
    terms, lam = model["terms"], model["lam"]

    def run(batches):
        for b in batches:
            stat, found = [], []
            for text in b.column(1).to_pylist():
                words = tokens(text)
                segs = segments(words, terms)
                stat.append(statistic(segs, len(words), lam))
                es = [(a, e, s, max(K * len(words), 1.0) * math.exp(-min(lam * s, 700))) for a, e, s in segs]
                found.append([dict(zip(("first", "end", "score", "e_value"), x)) for x in es if x[3] <= 1])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()),
                                       ("score", pa.float64()), ("e_value", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(stat, pa.float64()), pa.array(found, kind)],
                                             names=["doc_id", "statistic", "passages"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, statistic double, passages array<struct<first:long,end:long,score:double,e_value:double>>")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Terms and the logistic curve of the statistic (ridge-penalised Newton
    steps on a histogram of the training rows)."""
    from .common import Scratch
    train = Scratch(docs.sparkSession, "toxicity").save(training_rows(docs, labels))
    model = fit_terms(docs, train)
    rows = passages(train.select(F.col("toxic").alias("doc_id"), "text"), model)
    hist = rows.groupBy((F.col("doc_id") > 0).alias("y"), F.round(F.least("statistic", F.lit(50.0)), 1).alias("x")).count().collect()
    w = np.zeros(2)
    if model["terms"] and hist:
        x = np.array([[1.0, r["x"]] for r in hist])
        y = np.array([float(r["y"]) for r in hist])
        c = np.array([float(r["count"]) for r in hist])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (c * (y - p)) - np.array([0.0, 1.0]) * w
            h = (x * (c * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 1.0])
            w = w + np.clip(np.linalg.solve(h, g), -2, 2)
    else:
        rate = min(model["rate"], UNTOLD)
        w[0] = math.log((rate + 1e-3) / (1 - rate + 1e-3))
    return model | {"a": float(w[0]), "b": max(float(w[1]), 0.0)}


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score, predicted, passages of every row. Null and empty texts
    have no words and get the curve's lowest score. Repeated rows repeat. Where no
    term is significant (no usable labels, labels of one class only) every score
    is the base rate, 0.49 at most. Labels reach the result through the fitted
    model only."""
    model = fit(docs, labels)
    p = 1 / (1 + F.exp(-(F.lit(model["a"]) + F.lit(model["b"]) * F.col("statistic"))))
    out = passages(docs, model).withColumn("score", p)
    return out.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, labels).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                      "predicted", F.size("passages").alias("n_passages"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more. The statistic is
    computed where the row is, so no text moves."""
    model = fit(docs, labels)
    terms, lam, a, b = model["terms"], model["lam"], model["a"], model["b"]
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = []
            for text in batch.column(at).to_pylist():
                words = tokens(text)
                keep.append(a + b * statistic(segments(words, terms), len(words), lam) < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
