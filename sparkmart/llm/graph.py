"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of all ids in ``edges`` (a, b): component is the least id that can be reached.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    least neighbour, then its smaller ones.  Long chains halve, and a node of any degree is
    handled by an aggregate and a join, never in one group.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)

    def state(df: DataFrame):
        mixed = F.xxhash64("a", "b")
        return df.agg(F.count("*"), F.sum(mixed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(mixed, 32))).first()

    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lower, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            lower.select("a", F.col("m").alias("b"))
        )
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        after = state(now)
        if after == before:
            break
        before = after
    # Every node now has one edge, to the least of its component.
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
