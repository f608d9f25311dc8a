"""Hashing and deduplication (F1-F5) and the persisted hash list.

Exact dedup is an aggregate, not a window: ``min(struct(order..., payload))``
per hash is combined map-side, so a hash shared by a third of all rows costs
one row per input partition before the shuffle, never one task holding the
whole group.  The survivor is deterministic (smallest order key), unlike the
reference's arrival order.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HASH_SCHEMA = "hash string"


def with_hash(df: DataFrame, text_col: str = "text", out: str = "hash") -> DataFrame:
    """md5 hex of the UTF-8 text."""
    return df.withColumn(out, F.md5(F.col(text_col)))


def dedup_exact(df: DataFrame, order: list[str], key: str = "hash") -> DataFrame:
    """one row per ``key``: the one with the smallest ``order`` tuple."""
    payload = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + payload]).alias("_r")
    return (df.groupBy(key).agg(F.min(packed).alias("_r"))
            .select(key, *[F.col("_r")[c].alias(c) for c in order + payload])
            .select(*df.columns))


def drop_known(df: DataFrame, hash_list: DataFrame, key: str = "hash") -> DataFrame:
    """drop rows whose hash is in a saved hash list (left anti join; Spark
    broadcasts the list only when its size estimate is below the threshold,
    AQE re-decides on the runtime size).  A list in buckets is not shuffled."""
    return df.join(hash_list.select(F.col("hash").alias(key)), key, "left_anti")


def union_hashes(old: DataFrame, new_rows: DataFrame, key: str = "hash") -> DataFrame:
    """the hash list after a run: old hashes plus the newly emitted ones
    (disjoint by construction of F3)."""
    return old.select("hash").unionByName(new_rows.select(F.col(key).alias("hash")))


def duplicate_count(before: DataFrame, after: DataFrame) -> int:
    """rows dropped as duplicates (in-run plus known), in one job."""
    rows = before.select(F.lit(1).alias("w")).unionByName(after.select(F.lit(-1).alias("w")))
    return rows.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]


def load_hash_list(spark: SparkSession, path: str) -> DataFrame:
    """The saved hash list, or an empty one when the path does not exist.  A list saved by
    ``save_new_hashes`` is read by its buckets: a join on ``hash`` takes it as it lies, without moving it.  Other
    Parquet folders are read with all their columns."""
    if not path or not _exists(spark, path):
        return spark.createDataFrame([], HASH_SCHEMA)
    buckets = _buckets(spark, path)
    return spark.table(_bucketed(spark, path, buckets)) if buckets else spark.read.parquet(path)


def save_new_hashes(new_rows: DataFrame, path: str, key: str = "hash", buckets: int | None = None) -> None:
    """Append only the run's new hashes, so a run never rewrites the whole list.  The list is bucketed by
    hash, into as many buckets as the session has shuffle partitions when the list is begun (or
    ``buckets``): the corpus job's rows are then dealt like the list by the dedup itself, and neither
    side is shuffled for the anti join.  Each append adds one file a bucket.  A folder of another layout is
    appended to as it is.  Null hashes are not saved."""
    spark = new_rows.sparkSession
    rows = new_rows.select(F.col(key).alias("hash")).where("hash IS NOT NULL")
    found = _buckets(spark, path) if _exists(spark, path) else (buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not found:
        rows.write.mode("append").parquet(path)
        return
    # Dealt by the function that names the buckets, so each task writes one file.
    rows.repartition(found, "hash").write.insertInto(_bucketed(spark, path, found))


def _bucketed(spark: SparkSession, path: str, buckets: int) -> str:
    """The session's name of the bucketed table in ``path`` (the files lie in its folder ``buckets=N``)."""
    name = f"textmill_hashes_{hashlib.md5(path.encode()).hexdigest()}"
    place = f"{path.rstrip('/')}/buckets={buckets}".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({HASH_SCHEMA}) USING parquet CLUSTERED BY (hash) SORTED BY (hash) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)  # other sessions may have appended
    return name


def _buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the list in ``path``, if it has any."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in fs.listStatus(hpath)]
    return next((int(n.removeprefix("buckets=")) for n in sorted(names) if n.startswith("buckets=")), None)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath) if "://" in path else os.path.exists(path) or fs.exists(hpath)
