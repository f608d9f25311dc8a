"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors are hashed in several tables: a table's key joins ``k`` quantised random
projections floor((a.v + b) / WIDTH).  ``k`` grows with the logarithm of the number of vectors, so
that a vector meets few distant ones, and there are as many tables as bring the chance to miss a
pair at the threshold below MISS.  Vectors that share a bucket are compared by cosine in double
precision.

Equal vectors become one class, weighted by its size.  Buckets are dealt out as pairs of blocks of
at most BLOCK classes.  A pair counts in the first table that both share, so no list of pairs is
needed: a block pair returns sums of links by class, and links that span its components.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with
nothing, and so do rows with a null id; vectors of different lengths are never linked; ties go to the
smallest id; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.arrow import lists, ragged, whole_groups
from textmill.llm.graph import components
from textmill.llm.store import saved

THRESHOLD = 0.95
WIDTH = 2.0
MISS = 1e-4
#: Cosine of vectors that count as distant when ``k`` is chosen.
FAR = 0.155
BLOCK = 512
SMALL = 16
SEED = 7_919


def collision(cosine: float, width: float = WIDTH) -> float:
    """Chance that one projection puts two unit vectors of this cosine in the same cell (Datar et al. 2004)."""
    r = width / math.sqrt(2 - 2 * cosine)
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def plan(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(projections by table, tables) for ``n`` vectors."""
    k = 4 + math.ceil(math.log(max(n, 2)) / -math.log(collision(FAR)))
    return k, math.ceil(math.log(MISS) / math.log1p(-(collision(threshold) ** k)))


@lru_cache(maxsize=4)
def _projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dim, k, tables))
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, WIDTH, k * tables), rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)


def keys(vectors: np.ndarray, k: int, tables: int) -> np.ndarray:
    """32-bit bucket keys (rows x tables) of unit vectors."""
    a, b, mult = _projections(vectors.shape[1], k, tables)
    out = np.empty((len(vectors), tables), np.int32)
    for at in range(0, len(vectors), 1024):
        cells = np.floor((vectors[at : at + 1024] @ a + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(-1, tables, k)
        h = np.zeros(cells.shape[:2], np.uint64)
        for j in range(k):
            h = (h ^ cells[:, :, j] ^ (h >> np.uint64(31))) * mult[j]
        out[at : at + 1024] = ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    return out


def unit(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of the usable vectors, by length."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for dim in np.unique(n[n > 0]).tolist():
        rows = np.flatnonzero(n == dim)
        flat = column.take(pa.array(rows)).flatten()
        v = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # nulls become NaN
        with np.errstate(all="ignore"):
            scale = np.abs(v).max(axis=1)  # so that squares neither overflow nor vanish
            v = v / scale[:, None]
            v = v / np.sqrt((v * v).sum(axis=1))[:, None]
        ok = np.isfinite(v).all(axis=1)
        if ok.any():
            yield rows[ok], v[ok]


def _profiles(df: DataFrame, k: int, tables: int) -> DataFrame:
    """(id, dim, h1, h2, vector, keys): a 128-bit digest of the vector and its bucket keys."""

    def run(batches):
        import hashlib

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                column = part.column(1)
                dim = np.zeros(part.num_rows, np.int64)
                digest = np.zeros((part.num_rows, 2), np.int64)
                own = np.zeros((part.num_rows, tables), np.int32)
                for rows, v in unit(column):
                    dim[rows] = v.shape[1]
                    own[rows] = keys(v, k, tables)
                    digest[rows] = [np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64) for x in v + 0.0]
                usable = dim > 0
                counts = np.where(usable, tables, 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(dim.astype(np.int32)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                     column, lists(np.append(0, np.cumsum(counts)), pa.array(own[usable].ravel()))],
                    names=["id", "dim", "h1", "h2", "vector", "keys"])

    vector = df.schema["v"].dataType.simpleString()
    return df.mapInArrow(run, f"id bigint, dim int, h1 bigint, h2 bigint, vector {vector}, keys array<int>")


def _linked(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, part, low) from block pairs: links found, and an id of the same component."""

    def small(x, y, ids, weight):
        low = np.minimum(ids[x], ids[y])
        return np.concatenate([ids[x], ids[y]]), np.concatenate([weight[y], weight[x]]), np.concatenate([low, low])

    def large(link, ids, weight):
        """Sums by row, and the smallest id of its component within the group."""
        near = link | link.T
        some = near.any(axis=1)
        near, ids, weight = near[np.ix_(some, some)], ids[some], weight[some]
        low = ids.copy()
        while len(ids):
            nxt = np.minimum(low, np.where(near, low[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (nxt == low).all():
                break
            low = nxt
        return ids, near @ weight, low

    def run(batches):
        for batch, start in whole_groups(batches, 4):
            col = {c: batch.column(k) for k, c in enumerate(batch.schema.names)}
            size = np.diff(np.append(start, batch.num_rows))
            ids, weight, side, band = (col[c].to_numpy() for c in ("id", "weight", "side", "band"))
            one = col["i"].to_numpy() == col["j"].to_numpy()
            key = col["keys"].flatten().to_numpy().reshape(batch.num_rows, -1)
            width = pc.list_value_length(col["vector"]).to_numpy()
            vectors = {d: v for d in np.unique(width).tolist() for _, v in unit(col["vector"].filter(pa.array(width == d)))}
            place = np.zeros(batch.num_rows, np.int64)
            for d in vectors:
                place[width == d] = np.arange((width == d).sum())
            out = [small(*(np.zeros(0, np.int64),) * 2, ids, weight)]
            # Small groups: all their pairs at once.
            lead = ragged(start[size <= SMALL], size[size <= SMALL])
            meets = np.repeat(start + size, size)[lead] - lead - 1
            for at in range(0, len(lead), 4096):
                x, y = np.repeat(lead[at : at + 4096], meets[at : at + 4096]), ragged(lead[at : at + 4096] + 1, meets[at : at + 4096])
                ok = one[x] | (side[x] != side[y])
                x, y = x[ok], y[ok]
                close = np.zeros(len(x), bool)
                for d, v in vectors.items():
                    own = width[x] == d
                    close[own] = np.einsum("ij,ij->i", v[place[x[own]]], v[place[y[own]]]) >= threshold
                x, y = x[close], y[close]
                first = (key[x] == key[y]).argmax(axis=1) == band[x]
                out.append(small(x[first], y[first], ids, weight))
            for a, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
                v = vectors[int(width[a])][place[a : a + n]]
                link = np.triu(v @ v.T >= threshold, 1)
                if not one[a]:
                    link &= side[a : a + n, None] != side[None, a : a + n]
                x, y = np.nonzero(link)
                for b in range(0, len(x), 65536):  # those that an earlier table has counted
                    p, q = x[b : b + 65536], y[b : b + 65536]
                    t = int(band[a])
                    earlier = (key[a + p, :t] == key[a + q, :t]).any(axis=1)
                    link[p[earlier], q[earlier]] = False
                out.append(large(link, ids[a : a + n], weight[a : a + n]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["id", "part", "low"])

    return rows.select("band", "key", "i", "j", "side", "id", "weight", "vector", "keys").mapInArrow(run, "id bigint, part bigint, low bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, n_links, component_id, kept) by row of ``df``.  Components are read as they are (32-bit floats,
    or doubles for any other type of number); cosines are taken in double precision."""
    element = "float" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{element}>").alias("v"))
    k, tables = plan(df.count(), threshold)
    found = saved(_profiles(source, k, tables), "profiles")
    usable = found.where("dim > 0 AND id IS NOT NULL")
    classes = saved(usable.groupBy("dim", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "weights")
    members = usable.join(classes.withColumnRenamed("rep", "id"), ["id", "dim", "h1", "h2"]).dropDuplicates(["id", "dim", "h1", "h2"])
    members = saved(members, "classes")
    placed = members.select("id", "dim", F.posexplode("keys").alias("band", "key"))
    full = placed.groupBy("band", "key", "dim").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    rest = placed.join(full, ["band", "key", "dim"]).select(
        "band", (F.col("key").cast("long") * 65536 + F.col("dim")).alias("key"), "id", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "band", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "id")
    rest = rest.join(members.select("id", "weight", "vector", "keys"), "id").repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j")
    links = saved(_linked(rest, threshold), "links")
    roots = components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = links.groupBy("id").agg(F.sum("part").alias("others"))
    by_class = classes.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(
        roots.select(F.col("id").alias("rep"), "root"), "rep", "left").select(
        "dim", "h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    out = found.where("id IS NOT NULL").select("id", "dim", "h1", "h2").join(by_class.where("dim > 0"), ["dim", "h1", "h2"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    alone = found.where("id IS NULL").select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("component_id") == F.col(id_col), F.lit(True)))
