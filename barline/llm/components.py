"""Connected components of an edge table, by alternating stars.

Every round replaces each edge by one to the smallest neighbour of its upper end (large
star) and of its lower end (small star), until nothing changes.  Each round is a few
joins and aggregations with partial sums, written to the shared folder; no list of a
node's neighbours is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barline.llm.common import discard, release, scratch


def _staged(edges: DataFrame):
    """The edges written and read again; their path, their number and an order-free digest
    (observed while writing)."""
    seen, path = Observation(), scratch(edges.sparkSession, "edges")
    marked = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"))
    marked.write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), path, seen.get


def components(edges: DataFrame) -> DataFrame:
    """``edges``: long columns ``a``, ``b``.  Returns ``node, root`` with the smallest node of the
    component as root, for every node that has an edge to another."""
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, path, before = _staged(e)
    del edges
    release(e.sparkSession)  # what made the edges is not needed again
    while True:
        # large star: every neighbour above u goes to the least of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its neighbours below go to the least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter("u <> v").distinct())
        last = path
        e, path, after = _staged(small)
        discard(e.sparkSession, last)
        if after == before:
            break
        before = after
    roots = e.groupBy("u").agg(F.min("v").alias("root"))
    return (roots.select(F.col("u").alias("node"), "root")
            .unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))
