"""Connected components of a link table by alternating star contraction.

Each round replaces links by links to smaller nodes; a node's links are never gathered in one place:
the minimum of its neighbours is a partial aggregate and is joined back, so a node with very many
links is split by adaptive skew handling.  State lives in tables in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) with a > b.  Large star: larger neighbours of every node are linked to the
    smallest of its neighbourhood.  Small star: so are its smaller neighbours and itself."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = links.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        low = links.groupBy("a").agg(F.min("b").alias("m"))
        out = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every linked node; component is its smallest reachable node."""
    spark = links.sparkSession
    cur = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    while True:
        nxt = materialise(_star(_star(cur, large=True), large=False), "links")
        state = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        forget(spark, cur)
        cur = nxt
        if tuple(state) == mark:
            break
        mark = tuple(state)
    # fixed point: every node hangs on its component's smallest node
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
