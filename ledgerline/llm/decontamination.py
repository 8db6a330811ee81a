"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edits.

Texts and items are words (lower case, no ASCII punctuation at the ends). An
item of L words is in a document if some passage is within ``1 - similarity``
times L word edits of it.

Items fall in length classes [B, 2B). A document is read in windows of
W = B - S + 1 words at every S-th word (S = B / 4), an item at every word, so
each unedited passage has a window in common with its item whatever its place.
A CGK walk (Chakraborty, Goldenberg, Koucky 2016) copies the word under a
pointer at every step and moves the pointer by a random bit of (step, word):
after an edit the walks of two windows fall into step again, so edit distance
becomes Hamming distance. Each table has a walk of its own and samples ``K`` of
its coordinates as the key; the number of tables follows from the recall asked
for. Every other walk has twice its window's words as steps and reads all of
it, the rest have as many and read its first half, where indels have shifted it
less. A window is hashed only if it has as many of the items' words and word
pairs as an item's edits must leave in some window (:func:`least`), which loses
no passage. Candidates are verified by exact word-level edit distance.

The benchmark is a reference list: items are taken in blocks of ``ITEM_BLOCK``
(a documented size), documents are scanned once a block and never moved.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import tokens

SIMILARITY = 0.8
RECALL = 0.99
#: Sampled coordinates of a key.
K = 4
#: Share of coordinates in which the embeddings of a window and its edited copy
#: at SIMILARITY are taken to differ; sets the tables. At 0.35 (24 tables) items
#: of 100 words with 20 deletions had a recall of 0.88.
APART = 0.45
TABLES = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - APART) ** K))
ITEM_BLOCK = 2_000
MASK = 1023


def shape(n: int) -> tuple[int, int, int]:
    """Class, stride and window of an item of n words."""
    b = 1 << (n.bit_length() - 1)
    s = max(1, b // 4)
    return b, s, b - s + 1


def least(n: int) -> tuple[int, int]:
    """Words and word pairs of an item of n words that some window of any
    passage within its edits has at least.

    Of k edits, d are deletions; the passage has n - d words or more, at most
    k - d of them foreign, and a deletion breaks one pair, a foreign word two.
    A passage of B words or more holds a whole window; a shorter one leaves at
    most d words of a window outside. If it holds several, the edits cannot all
    lie in the first and in the last one, but for the words these share."""
    b, s, w = shape(n)
    k = int((1 - SIMILARITY) * n + 1e-9)
    words = pairs = 0
    for d in range(k + 1):
        outside = max(0, b - (n - d))
        alike = w - s * (max(0, n - d - b) // s)
        lost, broken = k - d + outside, 2 * (k - d) + d + outside
        if alike < w:
            lost = (lost + min(lost, max(0, alike))) // 2
            broken = (broken + min(broken, max(0, alike - 1))) // 2
        words, pairs = max(words, lost), max(pairs, broken)
    return max(0, w - words), max(0, w - 1 - pairs)


class Walks:
    """The seeded random bits, sampled coordinates and mixers of all tables."""

    def __init__(self, width: int, seed: int = 7):
        rng = np.random.default_rng([seed, width])
        self.width, self.steps = width, 2 * width
        ends = [self.steps if t % 2 else width for t in range(TABLES)]
        self.moves = rng.integers(0, 2, (TABLES, self.steps, MASK + 1), dtype=np.int8)
        self.at = [np.sort(rng.choice(n, min(K, n), replace=False)).tolist() for n in ends]
        self.mix = rng.integers(1, 1 << 62, (TABLES, K), dtype=np.uint64) | np.uint64(1)

    def keys(self, words: np.ndarray, starts: np.ndarray):
        """(table, keys of the windows words[start : start + width]) of every
        table. A walk that leaves its window reads zeros."""
        padded = np.append(words, -1) + 1
        bits, unsigned = padded & MASK, padded.astype(np.uint64)
        end, last = starts + self.width, len(words)
        for t, (moves, at) in enumerate(zip(self.moves, self.at)):
            key, pos, j = np.zeros(len(starts), np.uint64), starts.copy(), 0
            for step in range(at[-1] + 1):
                here = np.where(pos < end, pos, last)
                if step == at[j]:
                    key += unsigned[here] * self.mix[t, j]
                    j += 1
                pos += moves[step][bits[here]]
            yield t, key


def edit_passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest word edits between ``item`` and any passage of ``text``: (edits,
    start, end). Ties go to the earliest end."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    cols = np.arange(n + 1)
    for i, w in enumerate(item, 1):
        best = np.empty(n + 1, np.int64)
        best[0] = i
        swap = cost[:-1] + (text != w)
        drop = cost[1:] + 1
        best[1:] = np.minimum(swap, drop)
        frm = np.empty(n + 1, np.int64)
        frm[0] = 0
        frm[1:] = np.where(swap <= drop, start[:-1], start[1:])
        # insertions: carry the lowest (cost - column) to the right
        low = np.minimum.accumulate(best - cols)
        first = np.maximum.accumulate(np.where(best - cols == low, cols, 0))
        cost = low + cols
        start = frm[first]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Index:
    """LSH tables of one block of items (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocab: dict[str, int] = {}
        self.items, self.classes = [], {}
        for item_id, text in items:
            words = tokens(text)
            if words:
                ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words], np.int64)
                self.classes.setdefault(shape(len(ids)), []).append(len(self.items))
                self.items.append((item_id, ids))
        wide = len(self.vocab) + 1
        pairs = {c: np.unique(np.concatenate([self.items[i][1][:-1] * wide + self.items[i][1][1:] for i in members]))
                 for c, members in self.classes.items()}
        self.pairs = np.unique(np.concatenate([np.array([-1]), *pairs.values()]))
        self.tables = {}
        for (b, s, w), members in self.classes.items():
            walks = Walks(w)
            known = np.zeros(len(self.vocab) + 1, bool)
            entries = []
            for i in members:
                ids = self.items[i][1]
                known[ids] = True
                starts = np.arange(len(ids) - w + 1)
                for t, keys in walks.keys(ids, starts):
                    entries.append((np.full(len(starts), t), keys, np.full(len(starts), i), starts))
            t, key, item, shift = (np.concatenate(c) for c in zip(*entries))
            per = []
            for x in range(TABLES):
                # an item's windows with one key are one entry: (key, item, least and greatest shift)
                k, i, sh = key[t == x], item[t == x], shift[t == x]
                o = np.lexsort((sh, i, k))
                k, i, sh = k[o], i[o], sh[o]
                first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (i[1:] != i[:-1]))))
                last = np.concatenate((first[1:], [len(k)])) - 1
                per.append((k[first], i[first], sh[first], sh[last]))
            need = [min(x) for x in zip(*(least(len(self.items[i][1])) for i in members))]
            self.tables[b, s, w] = (walks, known, np.isin(self.pairs, pairs[b, s, w]), need, per)

    def hits(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(row, item index, edits, first word, end word), best per row and item.
        Equal windows of a row are one, and a row meets an item once for each
        stretch that tables name: repeated words make no pairs."""
        get = self.vocab.get
        ids, bounds = [], [0]
        for text in texts:
            found = [get(w, 0) for w in tokens(text)]
            ids.append(np.array(found, np.int64))
            bounds.append(bounds[-1] + len(found))
        words = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        bounds = np.array(bounds)
        if not len(words):
            return []
        # (row, item) -> passages' starts [from, to] that some table names
        maybe: dict[tuple[int, int], list[tuple[int, int]]] = {}
        pair = words[:-1] * (len(self.vocab) + 1) + words[1:]
        pair[(words[:-1] == 0) | (words[1:] == 0)] = -1
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        place[self.pairs[place] != pair] = 0
        for (b, s, w), (walks, known, joined, need, per) in self.tables.items():
            total = np.concatenate(([0], np.cumsum(known[words])))
            total_pairs = np.concatenate(([0], np.cumsum(joined[place])))
            begins = bounds[:-1]
            # a window at every s-th word, and one that ends at the text's end
            size = np.diff(bounds)
            count = np.where(size < w, 0, -(-(size - w) // s) + 1)
            row = np.repeat(np.arange(len(texts)), count)
            starts = begins[row] + np.minimum(
                s * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)), size[row] - w)
            enough = ((total[starts + w] - total[starts] >= need[0])
                      & (total_pairs[starts + w - 1] - total_pairs[starts] >= need[1]))
            row, starts = row[enough], starts[enough]
            for t, mine in walks.keys(words, starts):
                keys, item, least_shift, most_shift = per[t]
                lo, hi = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                hit = np.flatnonzero(hi > lo)
                if not len(hit):
                    continue
                # a row's windows with one key (repeated words) are looked at once
                hit = hit[np.lexsort((starts[hit], mine[hit], row[hit]))]
                new = np.ones(len(hit), bool)
                new[1:] = (row[hit][1:] != row[hit][:-1]) | (mine[hit][1:] != mine[hit][:-1])
                first = np.flatnonzero(new)
                last = np.concatenate((first[1:], [len(hit)])) - 1
                for f, e in zip(hit[first], hit[last]):
                    a, z, r = int(starts[f]), int(starts[e]), int(row[f])
                    for x in range(lo[f], hi[f]):
                        maybe.setdefault((r, int(item[x])), []).append((a - int(most_shift[x]), z - int(least_shift[x])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (r, i), found in sorted(maybe.items()):
            item = self.items[i][1]
            k = int((1 - SIMILARITY) * len(item) + 1e-9)
            parts: list[list[int]] = []
            for a, z in sorted(found):                  # spans that touch are verified as one
                lo, hi = max(a - 2 * k - 1, bounds[r]), min(z + len(item) + 2 * k + 1, bounds[r + 1])
                if parts and lo <= parts[-1][1]:
                    parts[-1][1] = max(parts[-1][1], hi)
                else:
                    parts.append([lo, hi])
            have = Counter(item.tolist())
            for lo, hi in parts:
                text = words[lo:hi]
                if sum((have & Counter(text.tolist())).values()) < len(item) - k:
                    continue
                edits, first, end = edit_passage(item, text)
                if edits <= k:
                    got = (edits, int(lo + first - bounds[r]), int(lo + end - bounds[r]))
                    if (r, i) not in best or got < best[r, i]:
                        best[r, i] = got
        return [(r, i, *x) for (r, i), x in sorted(best.items())]


def _blocks(benchmark: DataFrame):
    """Indexes of the benchmark's items, a block at a time."""
    items = (benchmark.where("text is not null")
             .groupBy(F.col("item_id").cast("long").alias("item_id"), "text").agg(F.count("*").alias("n")))
    n = max(1, math.ceil(items.count() / ITEM_BLOCK))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        if rows:
            yield Index([(r["item_id"], r["text"]) for r in rows])


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, edits,
    item_words, first_word, end_word (of the best passage).

    Null and empty texts hold nothing, items without words are in nothing,
    repeated documents and items with one id and several texts give a row each.
    Empty tables give no rows."""
    schema = "doc_id long, item_id long, edits long, item_words long, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark):
        def run(batches, index=index):
            for b in batches:
                found = index.hits(b.column(1).to_pylist())
                ids = b.column(0).to_pylist()
                cols = [[ids[r] for r, *_ in found], [index.items[i][0] for _, i, *_ in found],
                        [x[2] for x in found], [len(index.items[i][1]) for _, i, *_ in found],
                        [x[3] for x in found], [x[4] for x in found]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[
                    "doc_id", "item_id", "edits", "item_words", "first_word", "end_word"])
        out = out.union(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                        .mapInArrow(run, schema))
    return out


def op9(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminations(docs, benchmark)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item; rows are dropped in place."""
    at = docs.columns.index("text")
    for index in _blocks(benchmark):
        def run(batches, index=index):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r for r, *_ in index.hits(b.column(at).to_pylist())]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
