"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiva.session import Workspace


def _star(links: DataFrame, least: DataFrame, upward: bool) -> DataFrame:
    """Links of each node's neighbours (only larger ones, if ``upward``) to its least one."""
    met = links.join(least, "u")
    if upward:
        return met.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    rest = met.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return own.unionByName(rest)


def _tangled(links: DataFrame) -> bool:
    """Whether a node has several links upwards, or one while others hang on it."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return bool(nodes.agg(F.bool_or(F.col("up") + F.col("down") > 1)).first()[0])


def components(links: DataFrame, workspace: Workspace, label: str) -> DataFrame:
    """``node, component`` of every node with a link ``a, b`` but the least of its component,
    which names it.

    Alternates two steps that hang neighbours on the least node around, until only stars are
    left; the number of rounds grows with the logarithm of the longest chain. Each round is
    written to the shared folder, and nothing but one truth value reaches the driver.
    """
    current = workspace.keep(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        f"{label}_round_0",
    )
    turn = 0
    while _tangled(current):
        turn += 1
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        grown = _star(both, least, upward=True).distinct()
        least = grown.groupBy("u").agg(F.min("v").alias("least"))
        current = workspace.keep(
            _star(grown, least, upward=False).distinct(), f"{label}_round_{turn}"
        )
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
