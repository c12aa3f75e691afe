"""Connected components of a graph given as a table of edges, without holding it in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize

#: So many edges make one partition: a graph within it needs no shuffle, a larger one is dealt by node.
EDGES_PER_PART = 100_000


def _whole(df: DataFrame, n: int) -> DataFrame:
    """df in one partition if its n rows fit one; what follows needs no shuffle then."""
    return df.coalesce(1) if n <= EDGES_PER_PART else df


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges in the shared folder, and what tells two sets apart, gathered while they are written: their number and two sums of hashes."""
    seen = Observation()
    low = F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31))
    told = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x"), F.coalesce(F.sum(low), F.lit(0)).alias("s"))
    now = materialize(told)
    mark = (seen.get["n"], seen.get["x"], seen.get["s"])
    return _whole(now, mark[0]), mark


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges(a, b), long: label is the smallest node that can be reached.

    Large-star and small-star steps alternate until nothing changes, after some log2(longest chain) rounds. Each
    round is written to the shared folder, so lineage stays short and a lost executor costs one round at most. Edges that repeat count once,
    a node linked with itself alone is none, and an edge with a null is left out; without edges the result is empty.
    """
    given = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, marks = _written(given)
    while True:
        turned = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        both = now.select(turned.alias("e")).select("e.a", "e.b")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lowest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(lowest.select("a", F.col("m").alias("b")))
        (after, marks), before = _written(_whole(small, marks[0]).distinct()), marks
        if marks == before:
            break
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
