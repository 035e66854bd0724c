"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import written


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and component (its smallest node) of every node of ``links`` (a, b).

    Alternating large and small stars: every node hands its larger neighbours, then its
    smaller ones, to the smallest node it knows. Each round is written, so a lost executor
    costs one round at most. No node's neighbours are gathered: a hot node is a hot join
    key, which adaptive execution splits."""
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = _fingerprint(edges)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionAll(centres)


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)
