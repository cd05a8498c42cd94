"""Connected components of links, by rounds of joins; nothing gathers in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import stored


def _follow(steps: DataFrame, then: DataFrame) -> DataFrame:
    """node, to: where ``then`` leads on from each step's end (nowhere else: it stays)."""
    on = then.withColumnsRenamed({"node": "n", "to": "next"})
    return steps.join(on, F.col("to") == F.col("n"), "left").select("node", F.coalesce("next", "to").alias("to"))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root (least node of its component) for the nodes of ``links`` (a, b).

    Each round points every node to its least neighbour (a partial minimum, so a hub with a third of
    all links is one row per task), follows the pointers to their ends by repeated squaring, and puts
    these ends in place of the nodes; links whose ends have met go. Rounds and squarings end by
    themselves, after about the logarithm of the longest path."""
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), f"{name}-links")
    roots = None
    while not edges.isEmpty():
        to = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
                    .groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to")), f"{name}-least")
        while True:
            # Two squarings at a time: pointers of up to four steps, and nearly all are, end here.
            twice = _follow(to, to)
            further = stored(_follow(twice, twice).withColumnRenamed("to", "far").join(
                twice.withColumnRenamed("node", "n"), F.col("node") == F.col("n")).select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")), f"{name}-far")
            to = further.select("node", "to")
            if further.where("moved").isEmpty():
                break
        roots = to if roots is None else _follow(roots, to)
        ends = to.withColumnsRenamed({"node": "n", "to": "end"})
        moved = edges.join(ends, F.col("a") == F.col("n")).select(F.col("end").alias("x"), "b")
        moved = moved.join(ends, F.col("b") == F.col("n")).select("x", F.col("end").alias("y"))
        edges = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct(), f"{name}-links")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(roots.withColumnRenamed("to", "root"), f"{name}-roots")
