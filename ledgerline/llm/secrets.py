"""Secret scan with multipart credential linking.

Strong findings (whole texts, leftmost, not overlapping within a kind):
assign, access and hex, as the patterns below state. Weak candidates are no
secret alone: short assigned values, values of names such as secret_access_key,
key-like tokens without a label (long, of letters of both cases and digits, of
high entropy), user names, and endpoints. They are reported only where
complementary parts co-occur: a credential is an access identifier, a secret and an endpoint, and a weak
candidate counts when a part of another role lies in its scope (a paragraph,
i.e. text without an empty line) within ``REACH`` characters.

Linking is an interval join: each part's interval, widened by REACH, meets the
parts of the other roles in the same document and scope. Parts are cut into
bins of REACH characters, and each bin keeps the extremes of each role, so a
join row carries two numbers a role and no pair is ever made.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# fixed values: the base patterns and their least lengths
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "weak_secret", "weak_id", "endpoint", "key_like")
WORDS = ("passw", "secret", "token", "api")

WEAK_LEAST = 6
WEAK_ID = re.compile(r"\b(?:user(?:name)?|login|client_?id|account|email)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.@=-]{3,})",
                     re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"\b(?:https?|ftp|sftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20\"'<>]+")
KEY_NAME = re.compile(r"\b[a-z0-9_]*(?:secret|access|private|auth|account|signing)[a-z0-9_]*_key[\"']?\x20*[:=]\x20*[\"']?"
                      r"([A-Za-z0-9+/_.=-]{6,})", re.IGNORECASE | re.ASCII)
#: An unlabelled key: its least length and Shannon entropy in bits a character.
KEY_LIKE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
KEY_ENTROPY = 3.5
ID_WORDS = ("user", "login", "client", "account", "email")
#: Characters between complementary parts, at most.
REACH = 200
#: Which role a kind plays in a credential.
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret", "access": "id", "weak_id": "id",
        "endpoint": "endpoint", "key_like": "secret"}
ROLES = ("secret", "id", "endpoint")
WEAK = ("weak_secret", "weak_id", "endpoint", "key_like")
BREAK = re.compile(r"\n[ \t\r]*\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strong findings, sorted. The keyword
    test only skips texts without any keyword."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def key_like(token: str) -> bool:
    """Letters of both cases and a digit, and no more repetition than chance."""
    body = token.rstrip("=")
    if not (any(c.isdigit() for c in body) and any(c.islower() for c in body) and any(c.isupper() for c in body)):
        return False
    n = len(body)
    return -sum(c / n * math.log2(c / n) for c in Counter(body).values()) >= KEY_ENTROPY


def weak_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the weak candidates. A key name's value or a
    key-like token that lies in another part is none."""
    out = _weak_labelled(text)
    named = [(m.start(), 3, m.end()) for m in KEY_NAME.finditer(text)] if "_key" in text.lower() else []
    bare = [(m.start(), 6, m.end()) for m in KEY_LIKE.finditer(text) if key_like(m[0])]
    for keys in (named, bare):
        if keys:
            out += _apart(keys, out + base_spans(text))
    return out


def _apart(spans, others) -> list[tuple[int, int, int]]:
    """The ``spans`` that overlap none of ``others``."""
    others = sorted((s, e) for s, _, e in others)
    starts, reach = [s for s, _ in others], list(itertools.accumulate((e for _, e in others), max))
    out = []
    for s, k, e in spans:
        at = bisect.bisect_left(starts, e)                 # others that start before the span's end
        if not at or reach[at - 1] <= s:
            out.append((s, k, e))
    return out


def _weak_labelled(text: str) -> list[tuple[int, int, int]]:
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 3, m.end()) for m in ASSIGN.finditer(text)
                if WEAK_LEAST <= m.end(2) - m.start(2) < ASSIGN_LEAST]
    if any(w in low for w in ID_WORDS):
        out += [(m.start(), 4, m.end()) for m in WEAK_ID.finditer(text)]
    if "://" in text:
        out += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SPAN = pa.struct([("scope", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, key (digest of the text), the base counts and digest, and all
    parts (scope, kind, start, end)."""
    def run(batches):
        for b in batches:
            key, counts, sha, parts = [], ([], [], []), [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                weak = weak_spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(x[1] == k for x in base))
                sha.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every = sorted(base + weak)
                scopes = [m.start() for m in BREAK.finditer(text)] if weak else []
                at, mine = 0, []
                for s, k, e in every:
                    while at < len(scopes) and scopes[at] < s:
                        at += 1
                    mine.append({"scope": at, "kind": k, "start": s, "end": e})
                parts.append(mine)
                key.append(hashlib.md5(text.encode()).hexdigest() if weak else "")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(key), *[pa.array(c, pa.int64()) for c in counts], pa.array(sha),
                 pa.array(parts, pa.list_(_SPAN))],
                names=["doc_id", "key", "n_assign", "n_access", "n_hex", "base_sha256", "parts"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, key string, n_assign long, n_access long, n_hex long, base_sha256 string, "
             "parts array<struct<scope:long,kind:int,start:long,end:long>>")


def linked(parts: DataFrame) -> DataFrame:
    """The weak parts (key, scope, kind, start, end) that have a part of
    another role within REACH characters in their scope."""
    role = F.element_at(F.array(*[F.lit(ROLES.index(ROLE[k])) for k in KINDS]), F.col("kind") + 1)
    p = parts.withColumn("role", role)
    # every bin a part's interval touches knows its extremes by role
    touched = p.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / REACH),
                                                       F.floor(F.col("end") / REACH))))
    bins = (touched.groupBy(F.col("key").alias("k"), F.col("scope").alias("s"), F.col("bin").alias("n"), "role")
            .agg(F.min("start").alias("lo"), F.max("end").alias("hi")))
    bins = bins.groupBy("k", "s", "n").agg(F.collect_list(F.struct("role", "lo", "hi")).alias("others"))
    weak = (p.where(F.col("kind") >= KINDS.index(WEAK[0]))
            .withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - REACH) / REACH),
                                                    F.floor((F.col("end") + REACH) / REACH)))))
    near = F.exists("others", lambda o: (o["role"] != F.col("role"))
                    & (o["lo"] <= F.col("end") + REACH) & (o["hi"] >= F.col("start") - REACH))
    met = weak.join(bins, (F.col("key") == F.col("k")) & (F.col("scope") == F.col("s")) & (F.col("bin") == F.col("n")))
    return met.where(near).select("key", "kind", "start", "end").distinct()


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of every
    row. Null text is empty text: no spans. Equal texts are linked once, repeated
    rows repeat, a null doc_id is kept; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = scratch.save(scan(docs))
    parts = (rows.where("key <> ''").groupBy("key").agg(F.first("parts").alias("parts"))
             .select("key", F.explode("parts").alias("p")).select("key", "p.*"))
    extra = (linked(parts).groupBy(F.col("key").alias("__key"))
             .agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")))
    base = F.transform(F.filter("parts", lambda x: x["kind"] < 3), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    # rows without weak parts need no join; the others are few and narrow
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    plain = rows.where("key = ''").withColumn("more", none)
    with_weak = (rows.where("key <> ''").join(extra, F.col("key") == F.col("__key"), "left").drop("__key")
                 .withColumn("more", F.coalesce("more", none)))
    out = plain.unionByName(with_weak)
    spans = F.array_sort(F.concat(base, F.col("more")))
    text = F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, KINDS)), x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"),
                      F.size("more").cast("long").alias("n_linked"))


def op2(docs: DataFrame) -> DataFrame:
    return find_secrets(docs)
