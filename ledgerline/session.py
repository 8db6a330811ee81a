"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every pipeline relies on: UTC wall clock (timestamps are NTZ),
# AQE for runtime coalescing / skew-join splitting, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline",
                extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the launcher gives you
    and only make sure ``BASE_CONF`` is applied (see :func:`configure`)."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "4g"      # local mode: the driver is the executor
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable parts of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui."):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it; only when it is
    unset on a local master (tests) a fresh temporary folder is created; on a
    cluster that is an error, as executors would each write to their own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:                        # Spark Connect: no SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d.rstrip("/")
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")      # tests / local runs only
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/") if sc.getCheckpointDir() else d

