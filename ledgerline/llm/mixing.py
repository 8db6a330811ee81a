"""Mixing sources to target weights by a splitting tree of block quotas.

1. Targets: sources share ``share`` times all words by weight; no target may
   exceed ``most`` times its source, the excess goes to the others by weight.
2. Quotas: each source is read in passes, each pass in its own hash order.
   The mix takes a prefix of that sequence, exact to a word (the last document
   is cut). A block is one document in one pass; the source's quota is the
   number of blocks in its prefix.
3. Splitting tree: the quotas of all sources are halved again and again among
   the output shards. Each split draws the left half's counts from the
   multivariate hypergeometric distribution (sequential inverse-CDF draws with
   seeded uniforms), so shards are what a full random permutation would give,
   but only the small table of quotas is touched.
4. Each source's blocks, permuted by an affine map of their ranks, are cut
   into the shards' disjoint ranges and shuffled locally by hash.

All steps are DataFrame or SQL functions; results depend on contents and seed
only, so reruns agree. Equal rows are one weighted entry until the end.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import TARGET_ROWS, Scratch, expand_copies, prefix_sums

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> plus target. One row per source; the source
    list is the mix's configuration and is ranked as a whole.

    Water level: sources sorted by size per weight; the capped ones are a
    prefix, and the level is (all - capped sums) / (weights left)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    r = sizes.withColumn("n", F.row_number().over(by_name) - 1)
    r = r.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.col("n") % len(weights) + 1).cast("int")))
    r = (r.withColumn("all", F.sum("source_size").over(whole) * share)
         .withColumn("level", (F.col("all") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
                     / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("stays", F.col("level") * F.col("weight") <= most * F.col("source_size")))
    # the first source whose share stays below its bound sets the level for all after it
    r = r.withColumn("water", F.first(F.when(F.col("stays"), F.col("level")), ignorenulls=True)
                     .over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    bound = F.lit(most) * F.col("source_size")
    return r.select("source", "source_size", "n",
                    F.least(F.coalesce(F.col("water") * F.col("weight"), bound), bound)
                    .cast("double").alias("target"))


def _log_factorial(x: str) -> str:
    return (f"if({x} < 2, 0D, {x} * ln({x}) - {x} + 0.5D * ln({2 * math.pi!r}D * {x})"
            f" + 1D / (12 * {x}) - 1D / (360 * pow({x}, 3)) + 1D / (1260 * pow({x}, 5)))")


def _hypergeometric(total: str, good: str, draws: str, u: str) -> str:
    """SQL: inverse-CDF draw, walking outward from the mode. All doubles."""
    lf = _log_factorial
    log_p = (f"{lf('v.c')} - {lf('v.m')} - {lf('(v.c - v.m)')} + {lf('(v.t - v.c)')} - {lf('(v.d - v.m)')}"
             f" - {lf('(v.t - v.c - v.d + v.m)')} - {lf('v.t')} + {lf('v.d')} + {lf('(v.t - v.d)')}")
    # state: u left, the weights and places of the next outcomes above and below, the outcome
    return f"""
    aggregate(array(named_struct('t', {total}, 'c', {good}, 'd', {draws},
        'm', greatest(greatest(0D, {draws} - ({total} - {good})),
             least(least({good}, {draws}), cast(floor(({draws} + 1) * ({good} + 1) / ({total} + 2)) as double))))),
      0D, (z, v) -> aggregate(
        sequence(1, cast(24 + 12 * sqrt(v.d * v.c / greatest(v.t, 1D) * (1 - v.c / greatest(v.t, 1D))) as int)),
        named_struct('x', if(exp({log_p}) >= {u}, v.m, -1D), 'u', {u} - exp({log_p}),
                     'pa', exp({log_p}), 'pb', exp({log_p}), 'a', v.m, 'b', v.m),
        (s, i) -> if(s.x >= 0, s, aggregate(array(named_struct(
            'pa', s.pa * greatest(v.c - s.a, 0D) * greatest(v.d - s.a, 0D)
                  / ((s.a + 1) * greatest(v.t - v.c - v.d + s.a + 1, 1D)),
            'pb', s.pb * s.b * (v.t - v.c - v.d + s.b)
                  / (greatest(v.c - s.b + 1, 1D) * greatest(v.d - s.b + 1, 1D)))), s,
          (o, p) -> named_struct(
            'x', if(p.pa > 0 and p.pa >= o.u, o.a + 1,
                 if(p.pb > 0 and p.pa + p.pb >= o.u, o.b - 1, -1D)),
            'u', o.u - p.pa - p.pb, 'pa', p.pa, 'pb', p.pb, 'a', o.a + 1, 'b', o.b - 1))),
        s -> if(s.x >= 0, s.x, v.m)))"""


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(n, quota) -> (n, segs: array of (lo, hi, shard)): each source's ranks
    cut into disjoint ranges, one per output shard. Totals of the shards
    differ by one at most."""
    node = (quotas.agg(F.transform(F.array_sort(F.collect_list(F.struct(
                F.col("n").cast("long").alias("n"), F.col("quota").cast("double").alias("q")))),
                lambda s: F.struct(s["n"].alias("n"), F.lit(0.0).alias("lo"), s["q"].alias("q"))).alias("qs"))
            .select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "qs"))
    while_width = shards
    draw = _hypergeometric("s.t", "x.q", "s.d",
                           f"(pmod(xxhash64({seed}, first, width, x.n), 4503599627370496) / 4503599627370496D)")
    split = f"""
    aggregate(qs, named_struct('t', aggregate(qs, 0D, (a, x) -> a + x.q),
        'd', floor(aggregate(qs, 0D, (a, x) -> a + x.q) * floor(width / 2) / width) + 0D,
        'out', cast(array() as array<double>)),
      (s, x) -> aggregate(array(if(x.q <= 0 or s.d <= 0, 0D, if(s.d >= s.t, x.q, {draw}))), s,
        (o, k) -> named_struct('t', o.t - x.q, 'd', o.d - k, 'out', concat(o.out, array(k)))),
      s -> s.out)"""
    while while_width > 1:
        node = node.withColumn("left", F.expr(split))
        kids = F.when(F.col("width") <= 1, F.array(F.struct("first", "width", "qs"))).otherwise(F.array(
            F.struct(F.col("first"), F.floor(F.col("width") / 2).cast("int").alias("width"),
                     F.expr("transform(qs, (x, i) -> named_struct('n', x.n, 'lo', x.lo, 'q', left[i]))").alias("qs")),
            F.struct((F.col("first") + F.floor(F.col("width") / 2)).cast("int").alias("first"),
                     F.ceil(F.col("width") / 2).cast("int").alias("width"),
                     F.expr("transform(qs, (x, i) -> named_struct('n', x.n, 'lo', x.lo + left[i], 'q', x.q - left[i]))").alias("qs"))))
        node = node.select(F.explode(kids).alias("k")).select("k.*")
        while_width = math.ceil(while_width / 2)
    return (node.select(F.col("first").alias("shard"), F.explode("qs").alias("x"))
            .where("x.q > 0")
            .groupBy(F.col("x.n").alias("n"))
            .agg(F.collect_list(F.struct(F.col("x.lo").cast("long").alias("lo"),
                                         (F.col("x.lo") + F.col("x.q")).cast("long").alias("hi"),
                                         "shard")).alias("segs")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0,
        shards: int = 8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Returns (documents, blocks).

    documents: one row per input row — doc_id, size, source, source_size,
    target, taken (the words of its blocks), blocks (an array of pass, shard,
    position, words), text_hash. blocks: one row per block of the mix — source,
    doc_id, size, text_hash, copy, pass, words (under ``size`` for the block at
    the target only), shard, position (hash order inside the shard).

    Null text has size 0, a null source is a source (last), a null doc_id is a
    value. Documents without words are listed with taken 0 and give no block.
    Equal rows count one by one. Empty input gives no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    passes = math.ceil(most)
    items = scratch.save(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                    F.xxhash64("text").alias("text_hash"))
        .groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("copies"))
        .withColumn("words", F.col("size") * F.col("copies")))
    per_source = items.groupBy("source").agg(F.sum("words").alias("source_size"),
                                             F.count("*").alias("entries"))
    most_entries = per_source.agg(F.max("entries")).first()[0] or 1
    goal = scratch.save(targets(per_source.select("source", "source_size"), weights, share, most)
                        .withColumn("budget", F.round("target").cast("long")))
    # one entry per pass that the source's budget reaches; each pass has its own order
    draws = (items.where("size > 0").join(goal, items["source"].eqNullSafe(goal["source"]))
             .select(items["source"], "doc_id", "size", "text_hash", "copies", "words", "n", "source_size", "budget")
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
             .where("budget > pass * source_size")
             .withColumn("__k", F.xxhash64(F.lit(seed), "pass", "doc_id", "size", "text_hash")))
    draws = prefix_sums(draws, ["n", "pass"], "__k", {"w0": "words", "r0": "copies"},
                        ["doc_id", "size", "text_hash"], max(1, round(most_entries / TARGET_ROWS)))
    left = F.col("budget") - F.col("pass") * F.col("source_size") - F.col("w0")
    draws = draws.withColumn("left", F.least(F.greatest(left, F.lit(0)), F.col("words"))).where("left > 0")
    draws = scratch.save(draws.select(
        "source", "n", "doc_id", "size", "text_hash", "pass", "left", "r0",
        F.ceil(F.col("left") / F.col("size")).cast("long").alias("taken_copies")))
    # ranks over both passes: the first pass is whole if there is a second
    per_pass = draws.groupBy("n", "pass").agg(F.sum("taken_copies").alias("q"))
    w = Window.partitionBy("n").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    per_pass = per_pass.select("n", "pass", F.coalesce(F.sum("q").over(w), F.lit(0)).alias("r_pass"),
                               F.sum("q").over(Window.partitionBy("n")).alias("quota"))
    quotas = per_pass.select("n", "quota").distinct()
    plan = scratch.save(per_pass.join(splitting_tree(quotas, shards, seed), "n"))
    blocks = draws.join(F.broadcast(plan), ["n", "pass"]).withColumn("zero", F.lit(0).cast("long"))
    blocks = expand_copies(blocks, "zero", "taken_copies", "copy")
    rank = F.col("r_pass") + F.col("r0") + F.col("copy")
    step = F.when(F.col("quota") % 1000003 == 0, F.lit(1000033)).otherwise(F.lit(1000003)).cast("long")
    blocks = (blocks.withColumn("at", (rank * step + F.pmod(F.xxhash64(F.lit(seed), "n"), F.col("quota")))
                                % F.col("quota"))
              .withColumn("shard", F.filter("segs", lambda g: (g["lo"] <= F.col("at")) & (g["hi"] > F.col("at")))[0]["shard"])
              .withColumn("words", F.least(F.col("size"), F.col("left") - F.col("copy") * F.col("size"))))
    blocks = blocks.select("source", "doc_id", "size", "text_hash", "copy", "pass", "words", "shard",
                           F.xxhash64(F.lit(seed), "shard", "doc_id", "copy", "pass").alias("position"))
    # every copy with the blocks it was drawn for, one a pass at most
    keys = ["source", "doc_id", "size", "text_hash", "copy"]
    drawn = ["shard", "position", "pass", "words"]
    each = expand_copies(items.withColumn("zero", F.lit(0).cast("long")), "zero", "copies", "copy")
    none = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in drawn]
    rows = each.select(*keys, *none).unionByName(blocks.select(*keys, *drawn)).groupBy(*keys).agg(
        F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("taken"),
        F.array_sort(F.collect_list(F.when(F.col("shard").isNotNull(), F.struct("pass", "shard", "position", "words"))))
        .alias("blocks"))
    rows = rows.join(F.broadcast(goal), rows["source"].eqNullSafe(goal["source"])).select(
        *[rows[c] for c in rows.columns], "source_size", "target")
    documents = rows.select("doc_id", "size", "source_size", "target", "taken", "blocks", "source", "text_hash")
    return documents, blocks


def op7(docs: DataFrame) -> DataFrame:
    documents, blocks = mix(docs)
    return documents.select("doc_id", "size", "source_size", "target", "taken", "blocks")


def mixed_documents(docs: DataFrame, shards: int = 8, whole: bool = False, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document appears once
    for each of its blocks. With ``whole`` every text is whole, so a source
    exceeds its target by less than its last document; else the one at the
    target keeps its first words, joined by single spaces (and ``n_chars``,
    where there is such a column, follows).
    Partitions are in the order of shards, an equal number for each shard,
    and rows in the order of ``position``.
    Rows that agree in doc_id, source and text are copies of one document and
    get the other columns of one of them."""
    _, blocks = mix(docs, shards=shards, **options)
    cols = docs.columns
    keys = {"__s": F.col("source"), "__d": F.col("doc_id"), "__h": F.xxhash64("text")}
    one = docs.withColumns(keys).dropDuplicates(list(keys))
    b = blocks.select(F.col("source").alias("__bs"), F.col("doc_id").alias("__bd"), F.col("text_hash").alias("__bh"),
                      F.col("words").alias("__w"), F.col("size").alias("__n"),
                      F.col("shard").alias("__shard"), F.col("position").alias("__position"))
    rows = one.join(b, F.col("__s").eqNullSafe(F.col("__bs")) & F.col("__d").eqNullSafe(F.col("__bd"))
                    & (F.col("__h") == F.col("__bh")))
    if not whole:
        cut = F.col("__w") < F.col("__n")
        text = F.when(cut, F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1),
                                                F.col("__w").cast("int")), " ")).otherwise(F.col("text"))
        rows = rows.withColumn("text", text)
        if "n_chars" in cols:
            rows = rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                                   .otherwise(F.col("n_chars")))
    # ranges of position inside each shard: the sign bit flipped, 31 bits are in its order
    per = math.ceil(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) / shards)
    high = F.shiftrightunsigned("__position", 33).bitwiseXOR(F.lit(1 << 30).cast("long"))
    part = (F.col("__shard") * per + F.shiftright(high * F.lit(per), 31)).cast("int")
    return (rows.select(*cols, "__shard", "__position").repartitionById(per * shards, part)
            .sortWithinPartitions("__shard", "__position").select(*cols))
