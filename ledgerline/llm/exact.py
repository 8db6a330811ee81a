"""Exact dedup with a heavy-hitter split.

Texts are equal when their UTF-8 is identical after lower-casing A-Z only; null
counts as empty. The texts are read once into a written table of (doc_id,
SHA-256, row number). A Misra-Gries summary of the digests (the mergeable
frequent-items sketch behind ``approx_top_k``) names every digest that can hold
more than about 3.5 / ``TRACKED`` of the rows. For those candidates the exact
size and the winner are counted with partial aggregation, and the verified ones,
at most ``CANDIDATES`` rows of fixed width whatever the input, are broadcast:
copies of a frequent text are settled (or removed) where they are read. All
other digests are shuffled; none of them can fill a task. DataFrame and SQL
functions only.

Of equal texts the row with the largest doc_id stays; a null id is smaller than
any other, and of rows that repeat both id and text exactly one stays. Empty and
null texts are one group. An empty table gives no rows; other columns, whatever
their names, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Digests that one Misra-Gries summary tracks (16 bytes each).
TRACKED = 1 << 16
#: Most candidates that are verified: 3.5 / TRACKED of the rows hold fewer.
CANDIDATES = 20_000
#: A digest with fewer rows is not worth a broadcast entry.
HEAVY_ROWS = 256
#: Groups of map tasks whose summaries are merged before the last merge.
MERGE_GROUPS = 64


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()), 256))


def frequent(keys: DataFrame, key: str, tracked: int, k: int) -> DataFrame:
    """Candidates (item): a superset of the values of the bigint column ``key``
    with more than about 3.5 / ``tracked`` of the rows, at most ``k``. Map tasks
    summarise, groups of tasks merge, then one task merges the groups."""
    part = (keys.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"))
            .agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("s")))
    # grouped, as an ungrouped merge fails on a task without rows
    top = part.groupBy((F.col("g") < 0).alias("one")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    return (top.select(F.explode(F.expr(f"approx_top_k_estimate(s, {k})")).alias("e"))
            .select(F.col("e.item").alias("item")))


def winners(rows: DataFrame, heavy_rows: int = HEAVY_ROWS, tracked: int = TRACKED,
            candidates: int = CANDIDATES) -> DataFrame:
    """(d, size, win): the frequent digests of ``rows`` (doc_id, d, row) with
    their exact size and winning (doc_id, row); at most ``candidates`` rows."""
    hashed = rows.withColumn("__h", F.xxhash64("d"))
    cand = frequent(hashed, "__h", tracked, candidates)
    return (hashed.join(F.broadcast(cand), F.col("__h") == F.col("item"), "left_semi")
            .groupBy("d").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("win"))
            .where(F.col("size") >= heavy_rows))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", digest(F.col("text")).alias("d")).withColumn(
        "row", F.monotonically_increasing_id())


def groups(docs: DataFrame, heavy_rows: int = HEAVY_ROWS, tracked: int = TRACKED,
           candidates: int = CANDIDATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (doc_id of the row that
    stays), group_size, kept, text_sha256."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows = scratch.save(_narrow(docs))
    heavy = F.broadcast(scratch.save(winners(rows, heavy_rows, tracked, candidates)))
    out = ["doc_id", "keep_id", F.col("size").alias("group_size"), "kept",
           F.lower(F.hex("d")).alias("text_sha256")]
    settled = rows.join(heavy, "d").select(
        "doc_id", "d", "size", F.col("win.doc_id").alias("keep_id"), (F.col("row") == F.col("win.row")).alias("kept"))
    whole = Window.partitionBy("d")
    order = whole.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row").desc())
    rest = rows.join(heavy.select("d"), "d", "left_anti").select(
        "doc_id", "d", F.count(F.lit(1)).over(whole).alias("size"),
        F.first("doc_id").over(order).alias("keep_id"), (F.row_number().over(order) == 1).alias("kept"))
    return settled.select(*out).unionByName(rest.select(*out))


def deduplicate(docs: DataFrame, heavy_rows: int = HEAVY_ROWS, tracked: int = TRACKED,
                candidates: int = CANDIDATES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Losing copies of
    frequent texts are dropped in the map task that reads them; of the rest one
    row per digest is taken, at most one of a digest per map task is shuffled."""
    rows = Scratch(docs.sparkSession, "exact").save(_narrow(docs))
    heavy = winners(rows, heavy_rows, tracked, candidates).select(
        F.col("d").alias("__d"), F.struct("win.doc_id").alias("__win"))
    keyed = docs.withColumn("__digest", digest(F.col("text")))
    left = keyed.join(F.broadcast(heavy), F.col("__digest") == F.col("__d"), "left").where(
        F.col("__win").isNull() | F.col("doc_id").eqNullSafe(F.col("__win.doc_id")))
    w = Window.partitionBy("__digest").orderBy(F.col("doc_id").desc_nulls_last())
    return left.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op13(docs: DataFrame) -> DataFrame:
    return groups(docs.select("doc_id", "text"))


def oracle_sql() -> str:
    return f"""
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS z FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(z) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY z)"""
