"""Substring dedup: every byte covered by a LENGTH-byte string that also
starts earlier goes.

Suffixes are handled by buckets of a cover sample. The sample holds one
position of every LENGTH-byte window, its minimizer (the least hash among the
window's ANCHOR-byte strings), so two equal windows always hold the sample
position at the same distance: the property of a difference cover, at 2 / 70 of
the positions instead of a fifth. A suffix is then the few bytes up to its
sample position and the rank of the suffix there.

1. Sample: each document's anchors, with the run of windows that chose each
   and hashes of the anchor and of the run's bytes. No text moves. Equal runs
   within one group of texts are settled there.
2. Buckets: the anchors are sorted by (anchor, run, document, start) and read
   as streams. All but the first of equal runs are repeats as a whole. Anchors
   with several runs go on, one row a run.
3. Ranks: those rows get their bytes (runs of 100 to 168) and each bucket is
   sorted by itself: its suffixes at the sample positions to the right, its
   reversed prefixes to the left. Ranks cut at a depth name the strings of that
   length, so a window is a pair of names and ties cost no further bytes. Hot
   buckets, and the anchors that a Misra-Gries summary finds frequent, go on
   window by window instead, spread over all tasks.
4. Spans are merged per document and the rest is digested.

A task holds one group of documents' arrays (about GROUP bytes each) or one
bucket; a bucket above HOT rows is never held.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .exact import frequent

LENGTH, ANCHOR = 100, 32
WINDOW = LENGTH - ANCHOR + 1
GROUP = 1 << 19
_POS = np.uint64((1 << 20) - 1)
#: Rows of a bucket that one task ranks; larger ones go window by window.
HOT = 20_000
#: Anchors that the summary of frequent ones tracks, and names at most.
TRACKED, FREQUENT = 1 << 16, 20_000
#: Window digests that a task remembers.
SEEN = 50_000
#: Rows of a bucket that are compared two by two instead of ranked.
SMALL = 12


class Hashes:
    """Substring hashes of a byte array from prefix sums modulo 2^64."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 60, 1 << 62)) | 1
        inv = pow(base, -1, 1 << 64)
        self.up, self.down = self._powers(base, size), self._powers(inv, size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (prefix[end] - prefix[start]) * self.down[start]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, bounds: np.ndarray, hashes: Hashes):
    """Anchors of the texts data[bounds[i]:bounds[i+1]], for which at most
    2^20 bytes are given: (text, start of the run, windows - 1, bytes from its
    start to the anchor, anchor hash, run hash)."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    prefix = hashes.prefix(data)
    i = np.arange(len(data) - ANCHOR + 1)
    h = hashes.of(prefix, i, i + ANCHOR)
    m = (h & ~_POS) | i.astype(np.uint64)
    for step in (1, 2, 4, 8, 16, 32, WINDOW - 64):       # sliding minimum over WINDOW
        m = np.minimum(m[:-step], m[step:])
    text = np.searchsorted(bounds, np.arange(n), side="right") - 1
    inside = np.flatnonzero(np.arange(n) + LENGTH <= bounds[text + 1])
    if not len(inside):
        return (none,) * 4 + (none.astype(np.uint64),) * 2
    chosen = (m[inside] & _POS).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [len(inside)])) - 1
    s, e, p = inside[first], inside[last], chosen[first]
    return (text[s], s - bounds[text[s]], e - s, p - s, h[p], hashes.of(prefix, s, e + LENGTH))


def text_key(text: bytes) -> int:
    """64 bits of the text's MD5, which tell apart the texts that share a doc_id."""
    return int.from_bytes(hashlib.md5(text).digest()[:8], "big", signed=True)


def _pieces(texts: list[bytes]):
    """Groups of (row, offset, bytes) of about GROUP bytes. A long text comes
    in pieces that overlap by LENGTH - 1 bytes, so each of its windows is in
    one piece; a window chooses its anchor by its own bytes alone."""
    group, size = [], 0
    for row, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        at = 0
        while True:
            piece = t[at:at + GROUP]
            group.append((row, at, piece))
            size += len(piece)
            if size >= GROUP:
                yield group
                group, size = [], 0
            if at + GROUP >= len(t):
                break
            at += GROUP - LENGTH + 1
    if group:
        yield group


def _first_of_runs(h, c, d, g, pk) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal (h, c): the first in (d, g, pk) order, and the others
    (a row that repeats another one entirely is neither)."""
    order = np.lexsort((pk, g, d, c, h))
    same = np.ones(len(order), bool)
    same[:1] = False
    for x in (h, c):
        same[1:] &= x[order][1:] == x[order][:-1]
    twice = same.copy()
    for x in (d, g, pk):
        twice[1:] &= x[order][1:] == x[order][:-1]
    return order[~same], order[same & ~twice]


def sample(docs: DataFrame) -> DataFrame:
    """(k, h, c, d, g, pk): anchor hash, run hash, document (id, text key) and
    packed (run start, windows - 1, bytes to the anchor). Runs that occur earlier
    in the same group of texts are repeats already: they have no h. ``k`` is the
    key to shuffle by: a very common line sends one row per group of texts to its
    anchor's task and the rest anywhere."""
    def run(batches):
        hashes = Hashes(2 * GROUP + 1, 1)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for group in _pieces(texts):
                rows = np.array([r for r, _, _ in group])
                offs = np.array([o for _, o, _ in group])
                keys = np.array([text_key(texts[r]) for r, _, _ in group])
                data = np.frombuffer(b"".join(t for *_, t in group), np.uint8)
                bounds = np.concatenate(([0], np.cumsum([len(t) for *_, t in group])))
                t, s, more, to, h, c = anchors(data, bounds, hashes)
                pk = ((s + offs[t]) << 14) | (more << 7) | to
                h, c, d, g = h.view(np.int64), c.view(np.int64), ids[rows[t]], keys[t]
                lead, rest = _first_of_runs(h, c, d, g, pk)
                at = np.concatenate((lead, rest))
                known = np.arange(len(at)) >= len(lead)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(known, pk[at] * 31 + g[at], h[at])), pa.array(h[at], mask=known), pa.array(c[at]),
                     pa.array(d[at]), pa.array(g[at]), pa.array(pk[at])], names=["k", "h", "c", "d", "g", "pk"])
    return (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.col("text").cast("string"))
            .mapInArrow(run, "k long, h long, c long, d long, g long, pk long"))


def _repeats(batches):
    """Stream of (h, c, d, g, pk, hot) sorted by these, rows without h first.
    Yields whole repeats (h null) and, of anchors with several runs, the first row
    of each run (h set). A frequent anchor's runs are in many tasks, so each of
    its runs counts as one of several."""
    last = None                       # last row: h, c, d, g, pk
    lone = None                       # first row of the open anchor while it has one run
    for b in batches:
        if not b.num_rows:
            continue
        known = b.column(0).is_null().to_numpy(zero_copy_only=False)
        if known.any():
            done = b.filter(pa.array(known))
            yield pa.RecordBatch.from_arrays([done.column(i) for i in (0, 2, 3, 4, 5)], names=["h", "d", "g", "pk", "hot"])
            b = b.filter(pa.array(~known))
            if not b.num_rows:
                continue
        h, c, d, g, pk = (b.column(i).to_numpy() for i in range(5))
        hot = b.column(5).to_numpy(zero_copy_only=False).astype(bool)
        prev = [np.concatenate(([x[0] if last is None else last[i]], x[:-1])) for i, x in enumerate((h, c, d, g, pk))]
        new_h = h != prev[0]
        new_c = new_h | (c != prev[1])
        again = ~new_c & (d == prev[2]) & (g == prev[3]) & (pk == prev[4])      # a repeated row of one document
        if last is None:
            new_h[0] = new_c[0] = True
            again[0] = False
        whole = ~new_c & ~again
        r = np.flatnonzero(new_c)
        # runs of an anchor in this batch; the open one counts its pending first run
        other = ~new_h[r]
        many = other.copy()
        if len(r):
            many[:-1] |= other[1:]
        many |= hot[r]
        out = [[x[r[many]]] for x in (h, d, g, pk, hot)]
        if lone is not None and len(r) and other[0]:
            for o, v in zip(out, lone):
                o.append(np.array([v]))
        if len(r):
            x = r[-1]
            lone = (h[x], d[x], g[x], pk[x], False) if new_h[x] and not hot[x] else None
        last = (h[-1], c[-1], d[-1], g[-1], pk[-1])
        first = [np.concatenate(o) for o in out]
        w, f = int(whole.sum()), len(first[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((np.zeros(w, np.int64), first[0])), mask=np.arange(w + f) < w),
             *[pa.array(np.concatenate((x[whole], y))) for x, y in zip((d, g, pk, hot), first[1:])]],
            names=["h", "d", "g", "pk", "hot"])


def _unpack(pk):
    return pk >> 14, (pk >> 7) & 0x7F, pk & 0x7F


def _cut(batches):
    """(d, g, text, rows of (h, pk, hot)) -> the rows with the bytes of their runs
    and the key to shuffle by; a frequent anchor's rows lose their h."""
    for b in batches:
        texts = b.column(2).cast(pa.binary()).to_pylist()
        k, h, d, g, pk, run = [], [], [], [], [], []
        for doc, key, t, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, b.column(3).to_pylist()):
            for r in rows:
                s, more, _ = _unpack(r["pk"])
                k.append((r["pk"] ^ key) if r["hot"] else r["h"])
                h.append(None if r["hot"] else r["h"])
                d.append(doc)
                g.append(key)
                pk.append(r["pk"])
                run.append(t[s:s + more + LENGTH])
        yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (k, h, d, g, pk)], pa.array(run, pa.binary())],
                                          names=["k", "h", "d", "g", "pk", "run"])


def _same(a: bytes, b: bytes) -> int:
    return len(os.path.commonprefix((a, b)))


def _names(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``parts`` and common bytes of neighbours."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    lcp = np.array([0] + [_same(parts[x], parts[y]) for x, y in zip(order, order[1:])])
    return np.array(order), lcp


def bucket_repeats(rows: list[tuple[int, int, int, bytes]]) -> list[tuple[int, np.ndarray]]:
    """``rows`` (d, g, pk, run bytes) of one anchor in (d, g, pk) order. Gives (row,
    distances to the anchor of its windows that occur in an earlier row)."""
    s, more, to = _unpack(np.array([r[2] for r in rows], np.int64))
    left = [r[3][:t][::-1] for r, t in zip(rows, to.tolist())]
    right = [r[3][t:] for r, t in zip(rows, to.tolist())]
    low, n = to - more, len(rows)                 # a row's windows: distances low..to
    again = np.zeros((n, WINDOW), bool)
    if n <= SMALL:
        for x in range(1, n):
            for y in range(x):
                a = max(LENGTH - _same(right[x], right[y]), low[x], low[y])
                b = min(_same(left[x], left[y]), to[x], to[y])
                if a <= b:
                    again[x, a:b + 1] = True
    else:
        (ro, rl), (lo, ll) = _names(right), _names(left)
        index = np.arange(n)
        for o in range(int(low.min()), int(to.max()) + 1):
            here = index[(low <= o) & (o <= to)]
            if len(here) < 2:
                continue
            a, b = np.empty(n, np.int64), np.empty(n, np.int64)
            a[ro] = np.cumsum(rl < LENGTH - o)
            b[lo] = np.cumsum(ll < o)
            _, first = np.unique(a[here] * (n + 1) + b[here], return_index=True)
            rest = np.ones(len(here), bool)
            rest[first] = False
            again[here[rest], o] = True
    return [(x, np.flatnonzero(again[x])) for x in np.flatnonzero(again.any(axis=1)).tolist()]


def _ranked(batches):
    """Stream of (h, d, g, pk, run) sorted by (h, d, g, pk), frequent anchors' rows
    (no h) first. Yields repeated spans (d, g, start, end); of hot buckets and
    frequent anchors, (window digest, d, g, start, end)."""
    key, rows, hot, prev = None, [], False, None
    out: list[tuple] = []
    seen: set[bytes] = set()

    def close():
        if hot:
            spill()
        elif len(rows) > 1:
            for x, os_ in bucket_repeats(rows):
                d, g, pk, _ = rows[x]
                s, _, to = _unpack(pk)
                for part in np.split(os_, np.flatnonzero(np.diff(os_) > 1) + 1):
                    out.append((None, d, g, s + to - int(part[-1]), s + to - int(part[0]) + LENGTH))
        rows.clear()

    def spill():
        # rows come in document order, so a window seen before is a repeat here and
        # now; only the first of each goes on
        for d, g, pk, run in rows:
            s, more, _ = _unpack(pk)
            known = []
            for i in range(more + 1):
                w = hashlib.md5(run[i:i + LENGTH]).digest()
                if w in seen:
                    known.append((s + i, s + i + LENGTH))
                else:
                    seen.add(w)
                    out.append((w, d, g, s + i, s + i + LENGTH))
            out.extend((None, d, g, a, b) for a, b in merged(known))
        rows.clear()
        if len(seen) > SEEN:
            seen.clear()

    def flush():
        cols = list(zip(*out)) or [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                          names=["w", "d", "g", "start", "stop"])
    for b in batches:
        for h, d, g, pk, run in zip(*(b.column(i).to_pylist() for i in range(5))):
            if h != key:
                close()
                key, hot = h, False
                seen.clear()
            hot |= h is None
            if prev == (h, d, g, pk):
                continue                              # a repeated row of one document
            prev = (h, d, g, pk)
            rows.append((d, g, pk, run))
            if len(rows) >= HOT or hot:
                hot = True
                spill()
            if len(out) > 20_000:
                yield flush()
        yield flush()
    close()
    yield flush()


def _windows(batches):
    """Stream of windows sorted by (w, d, g, start): all but a digest's first."""
    last = None
    for b in batches:
        rows = list(zip(*(b.column(i).to_pylist() for i in range(5))))
        keep = []
        for r in rows:
            keep.append(last is not None and r[0] == last[0] and r[1:4] != last[1:])
            if last is None or r[0] != last[0]:
                last = r[:4]
        yield b.filter(pa.array(keep, pa.bool_())).select([1, 2, 3, 4])


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _removed(batches):
    for b in batches:
        texts = b.column(2).cast(pa.binary()).to_pylist()
        gone, n, sha, spans = [], [], [], []
        for t, found in zip(texts, b.column(3).to_pylist()):
            mine = merged((x["start"], x["stop"]) for x in found)
            gone.append(sum(e - s for s, e in mine))
            n.append(len(mine))
            spans.append([{"start": s, "stop": e} for s, e in mine])
            at, h = 0, hashlib.sha256()
            for s, e in mine:
                h.update(t[at:s])
                at = e
            h.update(t[at:])
            sha.append(h.hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(gone, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
             pa.array(spans, kind)], names=["d", "g", "n_removed", "n_spans", "sha", "spans"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (maximal removed
    runs of bytes) of every row.

    Null text is empty. Rows equal in doc_id and text are one document, listed
    as often as it occurs; different texts that share a doc_id are documents of
    their own, one after the other in the order of their text keys. A null doc_id
    comes before all others. Equal runs are told by 64-bit hashes, all other
    strings by their bytes. An empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    high, low = (F.conv(F.substring(F.md5(raw), a, 8), 16, 10).cast("long") for a in (1, 9))
    g = F.shiftleft(high, 32).bitwiseOR(low)                         # as text_key
    texts = docs.select(d.alias("d"), g.alias("g"), F.col("text").cast("string").alias("text"))
    # frequent anchors (a line of very many documents) are dealt out by run; the
    # broadcast list is FREQUENT numbers at most
    common = scratch.save(frequent(sample(docs).where("h is not null").select("h"), "h", TRACKED, FREQUENT))
    dealt = sample(docs).join(F.broadcast(common), F.col("h") == F.col("item"), "left")
    hot = F.col("item").isNotNull()
    dealt = dealt.select(F.when(hot, F.xxhash64("h", "c")).otherwise(F.col("k")).alias("k"), "h", "c", "d", "g", "pk",
                         hot.alias("hot"))
    cover = (dealt.repartition("k").select("h", "c", "d", "g", "pk", "hot").sortWithinPartitions("h", "c", "d", "g", "pk")
             .mapInArrow(_repeats, "h long, d long, g long, pk long, hot boolean"))
    cover = scratch.save(cover)

    def of(df, value, name):
        return df.groupBy(F.col("d").alias("__d"), F.col("g").alias("__g")).agg(F.collect_list(value).alias(name))

    def with_texts(side, name):
        long_ = texts.where("octet_length(text) >= 100")
        return long_.join(side, (F.col("d") == F.col("__d")) & (F.col("g") == F.col("__g"))).select("d", "g", "text", name)
    open_ = of(cover.where("h is not null"), F.struct("h", "pk", "hot"), "rows")
    runs = with_texts(open_, "rows").mapInArrow(_cut, "k long, h long, d long, g long, pk long, run binary")
    ranked = scratch.save(runs.repartition("k").drop("k").sortWithinPartitions("h", "d", "g", "pk")
                          .mapInArrow(_ranked, "w binary, d long, g long, start long, stop long"))
    single = (ranked.where("w is not null").repartition("w").sortWithinPartitions("w", "d", "g", "start")
           .mapInArrow(_windows, "d long, g long, start long, stop long"))
    s = F.shiftright("pk", 14)
    whole = cover.where("h is null").select(
        "d", "g", s.alias("start"), (s + F.shiftright("pk", 7).bitwiseAND(F.lit(0x7F)) + LENGTH).alias("stop"))
    spans = whole.union(ranked.where("w is null").drop("w")).union(single)
    per = of(spans, F.struct("start", "stop"), "spans")
    cut = with_texts(per, "spans").mapInArrow(_removed, "d long, g long, n_removed long, n_spans long, sha string, "
                                                        "spans array<struct<start:long,stop:long>>")
    cut = scratch.save(cut.where("n_removed > 0").dropDuplicates(["d", "g"])
                       .select(F.col("d").alias("__d"), F.col("g").alias("__g"), "n_removed", "n_spans", "sha", "spans"))
    all_ = docs.select("doc_id", d.alias("d"), g.alias("g"), F.octet_length(raw).cast("long").alias("n_bytes"),
                       F.sha2(raw, 256).alias("full_sha"))
    zero = F.lit(0).cast("long")
    return (all_.join(cut, (F.col("d") == F.col("__d")) & (F.col("g") == F.col("__g")), "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("sha", "full_sha").alias("kept_sha256"),
                    F.coalesce("spans", F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")).alias("spans")))


def op1(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).drop("spans")
