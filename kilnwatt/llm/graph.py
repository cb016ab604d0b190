"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatt.llm.common import phase
from kilnwatt.llm.decontaminate import _small
from kilnwatt.session import discard


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root): the least node of each component; nodes without an edge don't occur.

    `edges` has long columns a and b. Rounds alternate between hanging a node's greater neighbours and its smaller ones
    on its least neighbour; stars are left after a number of rounds that grows with the logarithm of the longest chain.
    Each round only aggregates by node and joins the minimum back, so a node with any number of neighbours is never one
    row or one group's list. The minima are written first: they are broadcast while few, and beyond that nothing stands
    between the join and its exchanges, so that the adaptive skew join can split a hub's rows.
    """
    now = phase(_directed(edges), f"{label}-edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        least = phase(least, f"{label}-least")
        larger = _directed(both.filter("b > a").join(_small(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        larger = phase(larger, f"{label}-large")
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        lowest = phase(lowest, f"{label}-lowest")
        joined = larger.join(_small(lowest), "a")
        smaller = joined.select("b", "m").unionByName(lowest.select(F.col("a").alias("b"), "m"))
        following = phase(_directed(smaller.select(F.col("b").alias("a"), F.col("m").alias("b"))), f"{label}-small")
        same = _same(now, following)
        discard(now, least, larger, lowest)
        if same:
            return following.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(following.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = following


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its greater to its smaller node; loops are dropped."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Equal sets of distinct edges, by counts and two sums of hashes."""
    total = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))]
    return one.agg(*total).first() == other.agg(*total).first()
