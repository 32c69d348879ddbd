"""Connected components of an edge list, by alternating large and small stars.

Every node's edges are turned towards the smallest node it knows, until nothing changes: a number of rounds that grows
with the logarithm of the longest chain. A round's rows never outnumber the edges; each round is written to the shared
checkpoint folder. Joins are plain equi-joins on both sides' shuffled keys, so that a hub's rows can be split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import cut


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """pairs (u, v): links the neighbours v of each u that are larger (or all, u included) to the smallest one known."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = pairs.join(least, F.col("u") == F.col("w"))
    if larger:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    return _each(joined, ("v", "m"), ("u", "m")).where("u <> v").distinct()


def _each(rows: DataFrame, *ends: tuple[str, str]) -> DataFrame:
    """(u, v) for each pair of columns named, in one pass over the rows (a union would run what stands before twice)."""
    return rows.select(F.explode(F.array(*(F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ends))).alias("x")).select("x.*")


def _settled(edges: DataFrame) -> bool:
    """Whether edges (u, v), distinct and with v < u, are stars: each u has one v, and no v is a u."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("low"), F.lit(0).alias("high")), F.struct(F.col("v").alias("n"), F.lit(0).alias("low"), F.lit(1).alias("high")))).alias("x"))
    return ends.groupBy("x.n").agg(F.sum("x.low").alias("low"), F.sum("x.high").alias("high")).where("low > 1 OR low > 0 AND high > 0").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (u long, v long) -> (node, root): each node that has an edge, and the smallest node of its component."""
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(rounds):
        if _settled(edges):
            break
        large = _stars(_each(edges, ("u", "v"), ("v", "u")), larger=True)
        edges = cut(_stars(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger=False))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return _each(edges, ("u", "v"), ("v", "v")).distinct().toDF("node", "root")
