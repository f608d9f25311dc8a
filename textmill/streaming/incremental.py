"""Structured Streaming forms of the corpus job.

S1: newly arrived files are cleaned and filtered with exactly the batch
column expressions (stateless, so any trigger works; ``availableNow`` drains
the backlog and stops).

S2: dedup across the whole stream, two ways:

* ``mode="state"`` (default): a stateful operator keeps one flag per hash in Spark's
  state store, so a micro-batch only looks up the hashes that it brings, however
  long the history is (:func:`dedup_stream`).  Equal rows of a micro-batch are
  combined before the shuffle; of those that are left the smallest in ``order`` stays.
  Output and state are committed together by the stream's checkpoint.
* ``mode="table"``: each micro-batch is deduplicated by hash, anti-joined with the
  hash table in the shared folder (reread by every batch), and its output rows and
  new hashes are written under their ``batch_id``.  A replayed batch overwrites its
  own partition and only consults hashes of earlier batches, so a restart after a
  lost executor or driver gives the same result (idempotent ``foreachBatch``).  The
  table is the saved hash list (B7).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators import dedup as dd
from textmill.session import checkpoint_dir


def clean_stream(stream: DataFrame, transform) -> DataFrame:
    """Apply a batch ``DataFrame -> DataFrame`` transform to a stream (stateless ops only)."""
    return transform(stream)


def _smallest_first(key: str, order: list[str]):
    """Of the rows of an Arrow batch that share a key, the smallest in ``order`` (nulls first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in order], null_placement="at_start"))
            seen: set = set()
            kept = [i for i, k in enumerate(rows[key].to_pylist()) if not (k in seen or seen.add(k))]
            yield from rows.take(pa.array(kept, pa.int64())).to_batches()

    return run


def _first_of_key(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Emit the smallest row of a key that has no state yet."""
    if state.exists:
        return
    best = None
    for part in parts:
        for order, row in zip(part["order"], part["row"]):
            rank = [(v is not None, v) for v in json.loads(order).values()]
            if best is None or rank < best[0]:
                best = rank, row
    if best is not None:
        state.update((True,))
        yield pd.DataFrame({"row": [best[1]]})


def dedup_stream(stream: DataFrame, order: list[str], key: str = "hash") -> DataFrame:
    """S2 with state: of all rows of the stream with one key (null is a key, too) one stays: of the first
    micro-batch that has it the smallest in ``order`` (nulls first), as in the batch operator.

    The state is one flag per key in the session's state store (with a RocksDB provider it may outgrow
    memory).  Rows pass the stateful operator as JSON, so types and nulls stay as they are; equal
    keys of an Arrow batch are combined before the shuffle, so a key that a third of all rows
    share costs a few rows a task."""
    combined = stream.mapInArrow(_smallest_first(key, order), stream.schema)
    every = {"ignoreNullFields": "false"}
    packed = combined.select(F.col(key).alias("key"), F.to_json(F.struct(*order), every).alias("order"), F.to_json(F.struct(*stream.columns), every).alias("row"))
    first = packed.groupBy("key").applyInPandasWithState(_first_of_key, "row string", "seen boolean", "append", "NoTimeout")
    return first.select(F.from_json("row", stream.schema).alias("r")).select("r.*")


def dedup_batch_writer(out_path: str, hashes_path: str, order: list[str], key: str = "hash"):
    """The ``foreachBatch`` function (see module doc)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        from pyspark import StorageLevel

        spark = batch.sparkSession
        # A micro-batch is bounded (maxFilesPerTrigger); it is read twice
        # below (emptiness test, dedup), so it is kept rather than recomputed.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            uniq = dd.dedup_exact(batch, order=order, key=key)
            known = dd.load_hash_list(spark, hashes_path)
            if "batch_id" in known.columns:
                known = known.where(F.col("batch_id") < batch_id)
            new = dd.drop_known(uniq, known.select("hash"), key=key).withColumn("batch_id", F.lit(batch_id))
            (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(out_path))
            written = spark.read.parquet(out_path).where(F.col("batch_id") == batch_id)
            (written.select(F.col(key).alias("hash"), "batch_id").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(hashes_path))
        finally:
            batch.unpersist()

    return write


def run_stream_dedup(spark: SparkSession, source_glob: str, schema, prepare, order: list[str],
                     name: str = "stream_dedup", max_files_per_trigger: int | None = None,
                     mode: str = "state") -> DataFrame:
    """Run S1 + S2 over the parquet files matching ``source_glob`` until no input is
    left (``availableNow``) and return the deduplicated output as a batch
    DataFrame.  State, outputs and the stream checkpoint live in the shared
    checkpoint folder.

    ``mode="state"``: :func:`dedup_stream`, written by the streaming file sink; a run
    that is started again under the same ``name`` goes on where it stopped.
    ``mode="table"``: the hash table above."""
    base = os.path.join(checkpoint_dir(spark), name)
    out_path, hashes_path, ckpt = (os.path.join(base, p) for p in ("out", "hashes", "ckpt"))
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = clean_stream(reader.parquet(source_glob), prepare)
    if mode == "state":
        q = (dedup_stream(stream, order).writeStream.format("parquet").option("path", out_path)
             .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out_path)
    q = (stream.writeStream.foreachBatch(dedup_batch_writer(out_path, hashes_path, order))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    if not dd._exists(spark, out_path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.parquet(out_path).drop("batch_id")
