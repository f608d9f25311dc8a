"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.store import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root) for every id in ``edges``; root is the smallest id that can be reached.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each step only takes minima
    by id, combined before the shuffle, and joins them back, so a star of any size is split over
    tasks.  Every round is written to the shared checkpoint folder.  Rows with a null end
    or equal ends are no links; an empty table gives an empty table.
    """
    links = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        links = saved(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = links.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
