"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours (large: those above it; small: those below it, and itself) to the least of all."""
    if large:
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            edges.select(F.col("v").alias("n"), F.col("u").alias("m"))
        )
    else:
        both = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m"))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("l"))
    joined = both.join(least, "n")
    if large:
        moved = joined.where("m > n").select(F.col("m").alias("u"), F.col("l").alias("v"))
    else:
        moved = joined.where("m <> l").select(F.col("m").alias("u"), F.col("l").alias("v")).unionByName(
            joined.select(F.col("n").alias("u"), F.col("l").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node of it) of every node that a link has. ``edges``: ``u, v``.

    A node with very many links is summed up by partial aggregation and its rows go out to its neighbours, so no
    list of links is ever held. Each round is written to the shared folder, which cuts the lineage; the rounds grow with
    the logarithm of the longest path. Loops and repeated links change nothing.
    """
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = None
    while True:
        now = materialize(_stars(_stars(now, True), False), "stars")
        state = tuple(now.agg(F.count("*"), total).collect()[0])
        if state == before:
            break
        before = state
    # Settled, each node but the least links to the least of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
