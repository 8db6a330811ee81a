"""Landed tables in the shared folder (``spark.checkpoint.dir``).

A derived feed is written once as Parquet (VARIANT columns round-trip) and
read back by every consumer, which cuts the lineage and makes later reads a
plain columnar scan. Writes go to a unique staging folder that is renamed
into place, so concurrent or retried jobs never observe a half-written table;
a lost executor only re-runs its own write tasks.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem + Path through the JVM gateway; None on sessions
    without one (Spark Connect), where callers fall back to plain reads."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return None, None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _readable(spark: SparkSession, path: str, fmt: str) -> bool:
    try:
        spark.read.format(fmt).load(path).limit(0).collect()
        return True
    except Exception:  # missing / empty path
        return False


def exists(spark: SparkSession, path: str) -> bool:
    """A landed table is complete once its ``_SUCCESS`` marker is there."""
    fs, p = _fs(spark, path.rstrip("/") + "/_SUCCESS")
    if fs is None:
        return _readable(spark, path.rstrip("/") + "/_SUCCESS", "text")
    return fs.exists(p)


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table folder holding data (partition folders or data files). Dynamic
    partition overwrites leave no root marker, so the folder is listed."""
    fs, p = _fs(spark, path.rstrip("/"))
    if fs is None:
        return _readable(spark, path, "parquet")
    if not fs.exists(p):
        return False
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    # same rule as Spark's file index: hidden unless it is a partition folder
    return any(not n.startswith(".") and (not n.startswith("_") or "=" in n) for n in names)


def landed(spark: SparkSession, name: str, source_key: str, build: Callable[[], DataFrame],
           version: str = "v1") -> DataFrame:
    """Read the landed table ``name`` for ``source_key``, building it first
    if it is not there yet."""
    digest = hashlib.sha1(f"{source_key}|{version}".encode()).hexdigest()[:16]
    final = f"{checkpoint_dir(spark)}/landed/{name}-{digest}"
    if not exists(spark, final):
        staging = f"{final}.staging-{uuid.uuid4().hex}"
        fs, _ = _fs(spark, staging)
        if fs is None:
            raise RuntimeError("landing a table needs the Hadoop file system for its atomic rename")
        build().write.mode("overwrite").option("compression", "zstd").parquet(staging)
        fs, src = _fs(spark, staging)
        _, dst = _fs(spark, final)
        if not fs.exists(dst):
            fs.rename(src, dst)
    return spark.read.parquet(final)


def landed_json(spark: SparkSession, name: str, source_key: str,
                build: Callable[[], dict[str, DataFrame]], times: dict[int, dt.datetime],
                version: str = "v1") -> str:
    """Land feeds as JSON files the way a fetcher does, once per ``source_key``:
    ``<root>/<feed>/<wave>/<partition key>/part-*.gz``, one record a line, files of
    a wave dated ``times[wave]``. ``build`` gives each feed's frame (wave,
    pk: the partition key, value, data; or, for the last two, their JSON ``line``),
    all rows of a (wave, pk) in one task:
    the caller spreads the rows before it makes the (much larger) records of them.
    Returns the root. Written aside and renamed into place like any landed table."""
    digest = hashlib.sha1(f"{source_key}|{version}".encode()).hexdigest()[:16]
    final = f"{checkpoint_dir(spark)}/landed/{name}-{digest}"
    fs, dst = _fs(spark, final)
    if fs is None:
        raise RuntimeError("landing files needs the Hadoop file system")
    if fs.exists(dst):
        return final
    staging = f"{final}.staging-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for feed, df in build().items():
        line = F.col("line") if "line" in df.columns else F.to_json(F.struct("value", "data"))
        (df.select("wave", "pk", line.alias("line"))
         .write.partitionBy("wave", "pk").option("compression", "gzip").text(f"{staging}/{feed}"))
        # Spark's folder names (wave=0/pk=10000) to the fetcher's (0/10000); file times
        for w in fs.listStatus(hadoop(f"{staging}/{feed}")):
            if not w.isDirectory():
                continue
            wave = w.getPath().getName().split("=")[1]
            at = int(times[int(wave)].replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
            fs.mkdirs(hadoop(f"{staging}/{feed}/{wave}"))

            def place(k, feed=feed, wave=wave, at=at):
                to = hadoop(f"{staging}/{feed}/{wave}/{k.getPath().getName().split('=')[1]}")
                fs.rename(k.getPath(), to)
                for f in fs.listStatus(to):
                    fs.setTimes(f.getPath(), at, -1)
            with ThreadPoolExecutor(8) as pool:
                list(pool.map(place, fs.listStatus(w.getPath())))
            fs.delete(w.getPath(), True)
    if not fs.exists(dst):
        fs.rename(hadoop(staging), dst)
    return final


#: Age at which a run's scratch folder is taken for left over.
EXPIRE_HOURS = 48


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run in the shared folder. Those of earlier runs of
    the same name go once they are ``EXPIRE_HOURS`` old: their results were lazy,
    so they could not be deleted by the run itself."""
    root = f"{checkpoint_dir(spark)}/runs/{name}"
    fs, p = _fs(spark, root)
    if fs is not None and fs.exists(p):
        limit = (time.time() - EXPIRE_HOURS * 3600) * 1000
        for s in fs.listStatus(p):
            if s.getModificationTime() < limit:
                fs.delete(s.getPath(), True)
    return f"{root}/{uuid.uuid4().hex}"
