"""Cross-tokenizer alignment: token groups, links and their corpus-wide counts.

Two public tokenizers encode every text: A a byte-level BPE (of a space and the
text), B a piece BPE with byte fallback (it adds the space). Each batch of an
Arrow task goes through Arrow kernels only: token lists are flattened, parent
indices and segmented running sums of the token lengths give each token's byte
end in its document, an Acero hash join on (document, end) finds the ends that
both tokenizers share, and ``Table.group_by`` counts a document's linked id
pairs. Spark merges these partial counts over the corpus.

Linked tokens end together, so one's bytes are a suffix of the other's: the two
vocabularies alone bound the number of id pairs (:func:`pair_bound`, 324,297
for the given ones), whatever the corpus. The merged counts are broadcast while
that bound is below ``BROADCAST_PAIRS``, and joined by a shuffle otherwise.

A text is tokenised ``PIECE`` characters at a time, cut before a single space
between two other characters. Neither tokenizer joins across such a place (A
splits there before merging; no piece of B goes on over a space), so the tokens
are those of the whole text, and a very long text needs no more memory than its
ids. The tokenizer files must be readable at one path on every executor.

A text that is null or empty, or whose joined token bytes are not a space and the
text, has no tokens: zeros and an empty groups_sha256. Every input row gives one
row, also repeated ones and those with a null id; an empty table gives none.
Other columns, whatever their names, do not matter.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Folder of the tokenizer files.
TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text bytes that are tokenised and joined at a time.
BATCH_BYTES = 1 << 20
#: Characters of a text that are encoded at a time.
PIECE = 1 << 16
#: Most id pairs that may be broadcast.
BROADCAST_PAIRS = 1 << 21

CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
PAIRS = "array<struct<a:int,b:int,n:int>>"


#: Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Coder:
    """Both tokenizers, with each id's bytes (null where an id stands for none).

    A's vocabulary and merges are read from its file. Where a merge's place in
    the list is its id's place too, as in the given file, merging by rank gives
    the same tokens and needs a fifth of the time; any other file is encoded by
    its own library."""

    def __init__(self, folder: str):
        import sentencepiece
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{FILE_B}")
        with open(f"{folder}/{FILE_A}", encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_of_char()
        vocab = spec["model"]["vocab"]
        known = {i: bytes(byte[c] for c in w) for w, i in vocab.items() if all(c in byte for c in w)}
        special = {t["id"] for t in spec["added_tokens"]}
        size = max([*known, *special]) + 1
        self.bytes_a = pa.array([None if i in special else known.get(i) for i in range(size)], pa.binary())
        self.encode_a = self._ranked(spec, known, special) or self._listed(folder)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([self._piece(i, p) for i, p in enumerate(pieces)], pa.binary())
        #: a piece that goes on over a space would forbid cutting before one
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)

    @staticmethod
    def _ranked(spec: dict, known: dict[int, bytes], special: set[int]):
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ranks = {w: i for i, w in known.items() if i not in special}
        split = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                                          "use_regex": True}
        in_order = all(spec["model"]["vocab"].get(x + y) == 256 + n for n, (x, y) in enumerate(merges))
        if not split or spec["normalizer"] or not in_order or len(ranks) != 256 + len(merges):
            return None
        import tiktoken
        ranked = tiktoken.Encoding(FILE_A, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [ranked.encode_ordinary(t) for t in texts]

    @staticmethod
    def _listed(folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        own = Tokenizer.from_file(f"{folder}/{FILE_A}")
        own.encode_special_tokens = True
        return lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, i: int, p: str) -> bytes | None:
        if self.b.is_byte(i):
            return bytes([int(p[3:5], 16)])
        return None if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Each text's ids by A and by B."""
        parts = [pieces(t, PIECE) if self.cuttable else [t] for t in texts]
        flat = list(itertools.chain.from_iterable(parts))
        of = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        a = self.encode_a([" " + p for p in flat])
        b = self.b.encode(flat, num_threads=1)
        return lists(a, of, len(texts)), lists(b, of, len(texts))


def byte_of_char() -> dict[str, int]:
    """Byte-level BPE's printable character for every byte: printable Latin-1
    bytes stand for themselves, the others for characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def coder(folder: str) -> Coder:
    return Coder(folder)


def pieces(text: str, limit: int) -> list[str]:
    """The text cut at single spaces (left out) after ``limit`` characters or more."""
    out, at = [], 0
    while len(text) - at > limit:
        m = CUT.search(text, at + limit)
        if m is None:
            break
        out.append(text[at:m.start()])
        at = m.end()
    out.append(text[at:])
    return out


def lists(parts: list[list[int]], of: np.ndarray, n: int) -> pa.ListArray:
    """One list per document from the ids of its pieces, which are in order."""
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    per = np.bincount(of, weights=sizes, minlength=n).astype(np.int64) if len(parts) else np.zeros(n, np.int64)
    ids = np.fromiter(itertools.chain.from_iterable(parts), np.int32, int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], per.cumsum()]), pa.int32()), pa.array(ids))


def joined(ids: pa.ListArray, vocab: pa.Array) -> pa.Array:
    """Each list's token bytes in one (null if an id has none)."""
    flat = vocab.take(pc.list_flatten(ids))
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, flat), pa.scalar(b"", pa.binary()))


def ends(ids: pa.ListArray, vocab: pa.Array, token: str) -> pa.Table:
    """(doc, end, token, at): flattened tokens with their document, their byte
    end in it (a running sum less the document's own start) and their place."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    size = pc.cast(pc.binary_length(vocab), pa.int64()).take(flat)
    total = pc.cumulative_sum(size)
    before = pc.subtract(total, size)
    start = before.take(ids.offsets.take(doc)) if len(flat) else before
    return pa.table({"doc": pc.cast(doc, pa.int64()), "end": pc.subtract(total, start), token: flat,
                     f"at_{token}": pa.array(np.arange(len(flat)))})


def runs(ids: pa.Array, last: np.ndarray) -> pa.Array:
    """Comma-joined ids of the runs that end at the places ``last``."""
    offsets = pa.array(np.concatenate([[0], last + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, pc.cast(ids, pa.string())), ",")


def align(code: Coder, texts: list[str | None]) -> dict[str, object]:
    """Columns of the documents' alignment: token, group and link counts, the
    groups' digest and the linked id pairs with their number in the document."""
    n = len(texts)
    full = np.array([i for i, t in enumerate(texts) if t], np.int64)
    out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digest, pair_n = [""] * n, np.zeros(n, np.int64)
    a, b = code.encode([texts[i] for i in full])
    want = pa.array([b" " + texts[i].encode("utf-8", "surrogatepass") for i in full], pa.binary())
    same = pc.and_(pc.equal(joined(a, code.bytes_a), want), pc.equal(joined(b, code.bytes_b), want))
    same = pc.fill_null(same, False)
    a, b, full = a.filter(same), b.filter(same), full[same.to_numpy(zero_copy_only=False)]
    links = ends(a, code.bytes_a, "a").join(ends(b, code.bytes_b, "b"), ["doc", "end"], join_type="inner",
                                            use_threads=False).sort_by("at_a")
    doc = links["doc"].to_numpy()
    groups = np.bincount(doc, minlength=len(full)).astype(np.int64) if len(full) else np.zeros(0, np.int64)
    if len(full):
        both = pc.binary_join_element_wise(runs(pc.list_flatten(a), links["at_a"].to_numpy()),
                                           runs(pc.list_flatten(b), links["at_b"].to_numpy()), "|")
        offsets = pa.array(np.concatenate([[0], groups.cumsum()]), pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(offsets, both), ";")
        for i, s in zip(full, lines):
            digest[i] = hashlib.sha256(s.as_buffer()).hexdigest()
    out["n_a"][full], out["n_b"][full] = a.value_lengths().to_numpy(), b.value_lengths().to_numpy()
    # a token has one end, so each group ends in exactly one linked pair
    out["n_groups"][full] = out["n_links"][full] = groups
    counted = (links.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
               .sort_by([("doc", "ascending"), ("a", "ascending"), ("b", "ascending")]))
    pair_n[full] = np.bincount(counted["doc"].to_numpy(), minlength=len(full)) if len(full) else 0
    fields = [counted["a"], counted["b"], pc.cast(counted["count_all"], pa.int32())]
    struct = pa.StructArray.from_arrays([f.combine_chunks() if isinstance(f, pa.ChunkedArray) else f for f in fields],
                                        ["a", "b", "n"])
    out["groups_sha256"] = pa.array(digest, pa.string())
    out["links"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], pair_n.cumsum()]), pa.int32()), struct)
    return out


def slices(texts: pa.Array, limit: int):
    """Index ranges of consecutive texts of about ``limit`` bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, held = 0, 0
    for i, s in enumerate(size):
        if held and held + s > limit:
            yield lo, i
            lo, held = i, 0
        held += int(s) + 1
    if lo < len(size):
        yield lo, len(size)


def aligned(docs: DataFrame, folder: str = TOKENIZERS, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
            ) -> DataFrame:
    """The ``keep`` columns and, per document, n_a, n_b, n_groups, n_links,
    groups_sha256 and links (its linked id pairs with their number in it)."""
    src = docs.select(*keep, F.col(text).alias("__text"))
    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema = f"{held}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links {PAIRS}"

    def run(batches):
        code = coder(folder)
        for batch in batches:
            for lo, hi in slices(batch.column("__text"), BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                cols = align(code, part.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], *[pa.array(v) if isinstance(v, np.ndarray) else v for v in cols.values()]],
                    names=[*keep, *cols])

    return src.mapInArrow(run, schema)


def pair_bound(code: Coder) -> int:
    """Number of id pairs of which one's bytes are a suffix of the other's: no
    corpus links any other pair."""
    a, b = (Counter(v for v in vocab.to_pylist() if v) for vocab in (code.bytes_a, code.bytes_b))
    under = sum(n * b.get(w[i:], 0) for w, n in a.items() for i in range(len(w)))
    return under + sum(n * a.get(w[i:], 0) for w, n in b.items() for i in range(1, len(w)))


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, count, best): corpus-wide links of each id pair, and whether no
    other pair of the same B id has more. One row per linked pair of ids."""
    links = rows.select(F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.sum("l.n").alias("count"))
    return links.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def scored(rows: DataFrame, counts: DataFrame, bounded: bool) -> DataFrame:
    """``rows`` of :func:`aligned` with n_best and count_sum in place of links.
    ``bounded``: the counts may be broadcast."""
    held = [c for c in rows.columns if c != "links"]
    flat = rows.withColumn("__row", F.monotonically_increasing_id()).select(
        "__row", *held, F.explode_outer("links").alias("__l"))
    side = F.broadcast(counts) if bounded else counts
    met = flat.join(side, (F.col("__l.a") == counts["a"]) & (F.col("__l.b") == counts["b"]), "left")
    n = F.col("__l.n").cast("long")
    return met.groupBy("__row", *held).agg(
        F.coalesce(F.sum(F.when(F.col("best"), n)), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(n * F.col("count")), F.lit(0)).cast("long").alias("count_sum")).drop("__row")


def op12(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "tokens")
    rows = scratch.save(aligned(docs, folder))
    counts = scratch.save(pair_counts(rows))
    return scored(rows, counts, pair_bound(coder(folder)) <= BROADCAST_PAIRS)
