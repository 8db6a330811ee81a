"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Rows that one window partition of :func:`prefix_sums` aims at.
TARGET_ROWS = 4_096
#: Copies that one task expands at a time in :func:`expand_copies`.
COPY_CHUNK = 65_536


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Age in hours at which an operator's written intermediates are taken for left over.
EXPIRE_HOURS = 48


class Scratch:
    """Written intermediates of one run in the shared folder that
    ``spark.checkpoint.dir`` names: each cuts the lineage, survives lost
    executors, and can be dropped once its readers are done. What the lazy
    result still reads cannot be dropped by the run itself: a later run of the
    same operator deletes it after ``EXPIRE_HOURS``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        base = checkpoint_dir(spark)
        self.root = f"{base}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        limit = (time.time() - EXPIRE_HOURS * 3600) * 1000
        for s in (fs.listStatus(path) if fs.exists(path) else ()):
            if re.fullmatch(f"{name}-[0-9a-f]{{32}}", s.getPath().getName()) and s.getModificationTime() < limit:
                fs.delete(s.getPath(), True)

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long")


def prefix_sums(df: DataFrame, group: list[str], key: str, values: dict[str, str],
                tie: list[str], buckets: int) -> DataFrame:
    """Exclusive running sums of ``values`` ({new column: column}) within each
    group in the order of the hash column ``key`` (ties: ``tie``).

    Each group is cut into ``buckets`` ranges of the hash, a running sum over
    the ranges' totals gives each range its offset, and rows are summed inside
    their range only, so no window holds a whole group."""
    df = df.withColumn("__b", F.shiftright(F.shiftrightunsigned(F.col(key), 33) * F.lit(buckets), 31))
    tot = df.groupBy(*group, "__b").agg(*[F.sum(c).alias(f"__t_{n}") for n, c in values.items()])
    w = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*[F.col(g).alias(f"__g_{g}") for g in [*group, "__b"]],
                     *[F.coalesce(F.sum(f"__t_{n}").over(w), F.lit(0)).alias(f"__o_{n}") for n in values])
    joined = df.join(off, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in [*group, "__b"]])
    w = (Window.partitionBy(*group, "__b").orderBy(key, *tie)
         .rowsBetween(Window.unboundedPreceding, -1))
    return joined.select(*[c for c in df.columns if c != "__b"],
                         *[(F.col(f"__o_{n}") + F.coalesce(F.sum(c).over(w), F.lit(0))).alias(n)
                           for n, c in values.items()])


def expand_copies(df: DataFrame, lo: str, hi: str, index: str) -> DataFrame:
    """One row for each integer of [lo, hi): first in chunks, so a row that
    stands for very many copies never becomes one array."""
    chunked = df.withColumn("__c", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(hi) - F.col(lo) - 1) / COPY_CHUNK).cast("long"))))
    start = F.col(lo) + F.col("__c") * COPY_CHUNK
    return (chunked.withColumn(index, F.explode(F.sequence(
        start, F.least(start + COPY_CHUNK, F.col(hi)) - 1))).drop("__c"))
