"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from textmill.session import checkpoint_dir


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the session's checkpoint folder and read again.

    This cuts the lineage: a lost executor never costs more than the tables after this one.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
