"""Connected components of an edge table by alternating star contraction.

Each round is two groupings: every node links its larger neighbours to its
smallest one (large star), then its smaller neighbours to the smallest (small
star).  The edge count never grows, and the rounds needed grow with the
logarithm of the longest chain.  Tables between rounds are written to the
shared folder; nothing is collected but two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.shared import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = both.join(low, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(doc, comp)`` for every node of ``edges (a, b)``; ``comp`` is the smallest node reachable."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = saved(edges.distinct(), "edges", narrow=True), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = saved(_star(_star(now, True), False), "edges", narrow=True)
    # settled: every node but the smallest of its component links to that smallest
    return now.select(F.col("a").alias("doc"), F.col("b").alias("comp")).unionByName(
        now.select(F.col("b").alias("doc"), F.col("b").alias("comp")).distinct())
