"""Spark session defaults for text-heavy, CPU-bound jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Cleaning costs many regex passes per byte, so scan splits stay small; AQE
# coalesces the shuffle partitions that the dedup / vocabulary stages leave
# nearly empty and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Per-document side tables (ratios, flags) are tiny next to the text they
    # join back to: hash the small side instead of sorting the text.
    "spark.sql.join.preferSortMergeJoin": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "textmill", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster launcher keeps control of them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, stream state and scratch tables: the
    session's ``spark.checkpoint.dir``.  Whoever builds the session names it
    (all executors must reach it); without it this raises."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
