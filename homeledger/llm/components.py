"""Connected components of an edge table, by alternating star contractions.

Each round points every node at the smallest node it sees, first from the larger
neighbours, then from the smaller ones; it ends when the edges no longer change and are
stars. Rounds are written tables in the shared folder, so a lost executor repeats one
round. Nothing but two numbers per round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homeledger.operators.joins import attach
from homeledger.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = cut_lineage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "star")
    least = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "star")
    seen = attach(both, least, "a", "n")
    return seen.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    edges = cut_lineage(edges, "star")
    least = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "star")
    seen = attach(edges, least, "a", "n")
    return (
        seen.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node with an edge; ``edges`` are (a, b), a component is
    called by its smallest node. Loops, repeats and either direction are fine."""
    edges = cut_lineage(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        edges = cut_lineage(_small_star(_large_star(edges)), "edges")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component")))
        mark = tuple(row)
    raise RuntimeError(f"not contracted after {rounds} rounds")
