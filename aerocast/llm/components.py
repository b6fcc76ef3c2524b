"""Connected components of an edge table by alternating large-star and
small-star steps; no edge list leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v; every node's neighbours are tied to the least of them.

    The least neighbour comes from an aggregate that combines before the
    shuffle and is joined back, so a node with very many edges is split by
    adaptive execution like any skewed join key."""
    both = edges.select(F.col("u").alias("at"), F.col("v").alias("to"))
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("at"), F.col("u").alias("to")))
    least = both.groupBy("at").agg(F.min("to").alias("m")).withColumn("m", F.least("m", "at"))
    tied = both.join(least, "at")
    if large:
        tied = tied.filter("to > at").select(F.col("to").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("to").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("at").alias("u"), F.col("m").alias("v")))
    return tied.filter("u != v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least id that each node of an edge reaches; nodes
    without edges are not listed, nulls and loops are ignored."""
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .filter("u is not null and v is not null and u != v").distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        state = mark
        now = written(_stars(_stars(now, True), False), "edges")
