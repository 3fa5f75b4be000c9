"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "rulelake") -> SparkSession:
    """Session tuned for the engine.

    AQE re-plans joins from runtime sizes (so broadcast only happens when a
    side is measured to be small), coalesces small shuffle partitions and
    splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is. Only
    when it is unset (local runs, tests) a private folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                               "on a cluster; a machine-local folder would not survive executor loss")
        conf_dir = tempfile.mkdtemp(prefix="rulelake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # noqa: BLE001 - core conf may be read-only; the context dir below is what counts
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (stream state, cut tables)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
