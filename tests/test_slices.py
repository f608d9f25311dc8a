"""Token lists are worked on in slices of bounded size; the values do not depend on them."""

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from textmill.operators import classify as cl
from textmill.operators import vocab as vb

LISTS = [["a", "b"], [], ["c"] * 9, None, ["a"], ["b", "zz"], ["a", "a", "b"]]


def test_no_slice_is_longer_than_the_limit(monkeypatch):
    monkeypatch.setattr(vb, "SLICE_TOKENS", 4)
    lists, more, sizes = pa.array([["x"], *LISTS], pa.list_(pa.string())).slice(1), pa.array(range(7)), []

    def fn(part, other):
        sizes.append(len(part.flatten()))
        return pa.array([f"{o}:{len(p or [])}" for o, p in zip(other.to_pylist(), part.to_pylist())], pa.string())

    assert vb.in_slices(fn, lists, more).to_pylist() == [f"{i}:{len(p or [])}" for i, p in enumerate(LISTS)]
    assert sorted(sizes)[-1] == 9 and sorted(sizes)[-2] <= 4  # a longer single list is taken alone
    assert vb.in_slices(fn, lists.slice(0, 0), more.slice(0, 0)).to_pylist() == []


def test_vectors_hold_the_lists(spark):
    row = spark.createDataFrame([([1, 5], [0.5, 0.25]), ([], [])], "i array<int>, w array<double>")
    bow = row.select(F.struct(F.col("i").alias("id"), F.col("w").alias("weight")).alias("b"))
    got = [r.v for r in bow.select(cl.vector_column(F.col("b"), 8).alias("v")).collect()]
    assert got == [SparseVector(8, [1, 5], [0.5, 0.25]), SparseVector(8, [], [])] and np.isclose(got[0].norm(1), 0.75)
