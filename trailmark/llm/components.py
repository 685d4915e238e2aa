"""Connected components by alternating star contraction, wholly as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.runtime import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a long, b long) -> (node, root): root is the smallest node reachable; only nodes of an edge appear.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest
    neighbour (Kiveris et al. 2014); a path of n nodes takes about log2 n rounds. Minima are
    aggregated before the shuffle, so that a hub's edges never meet in one list. Loops and repeats
    of an edge change nothing; no edge: no row. Rows with a null are left out.
    """
    e = edges.where("a is not null and b is not null and a <> b")
    e = cut(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.*")
        e = cut(small.where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("star contraction did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
