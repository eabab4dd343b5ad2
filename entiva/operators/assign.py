"""One-to-one assignment over scored pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.session import Workspace

LEFT, RIGHT = "left", "right"


def tie_break() -> Column:
    """A fixed pseudo-random number per pair, the same on every run and layout.

    Equal scores are common. Breaking them by name would let every left name want the same
    right name, and a round would settle one pair; a per-pair number settles many at once.
    """
    digest = F.md5(F.concat("left", F.lit("\u0001"), "right"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def one_to_one(pairs: DataFrame, workspace: Workspace, label: str) -> DataFrame:
    """Greedy best-first matching: no left and no right name is used twice.

    Pairs (``left``, ``right``, ``score``), each at most once, are ordered by score, then
    ``tie_break``, then the names. Every name points to its best pair. Each round takes the
    pairs that both their ends point to; names that pointed to a taken end go on to their next
    best pair with a free end, the others stay as they are. With a strict order this gives
    exactly what taking pairs one at a time would give, whatever the row order.

    The pairs are written once and only filtered afterwards. A round writes one row for each
    name that is still open, and shuffles the pairs of the names that go on. Every round takes
    at least the best pair left, so the loop ends when no name points to any.
    """
    ranked = workspace.keep(
        pairs.select("left", "right", "score").withColumn("tie", tie_break()), f"{label}-pairs"
    )
    best = workspace.keep(
        _best(_seen_from(ranked, LEFT).unionByName(_seen_from(ranked, RIGHT))), f"{label}-best-0"
    )
    step = 0
    while not best.isEmpty():
        both = best.groupBy("left", "right").agg(
            F.count(F.lit(1)).alias("ends"), F.any_value("score").alias("score")
        )
        taken = workspace.keep(
            both.filter("ends = 2").drop("ends"), f"{label}-taken/round={step}"
        )
        gone = workspace.rounds(f"{label}-taken").select("left", "right")
        still = best
        for side in (LEFT, RIGHT):
            # a name that is taken itself
            own = taken.select(F.col(side).alias("name"), F.lit(side).alias("side"))
            still = still.join(own, ["side", "name"], "left_anti")
        goes_on = reduce(
            DataFrame.unionByName,
            [
                still.filter(F.col("side") == side).join(
                    taken.select(other), other, "left_semi"
                ).select("side", "name")
                for side, other in ((LEFT, RIGHT), (RIGHT, LEFT))
            ],
        )
        stays = still.join(goes_on, ["side", "name"], "left_anti")
        free = [
            _seen_from(
                ranked.join(
                    goes_on.filter(F.col("side") == side).select(F.col("name").alias(side)),
                    side,
                    "left_semi",
                ).join(gone.select(other), other, "left_anti"),
                side,
            )
            for side, other in ((LEFT, RIGHT), (RIGHT, LEFT))
        ]
        best = workspace.keep(
            stays.unionByName(_best(free[0].unionByName(free[1]))), f"{label}-best-{step + 1}"
        )
        workspace.drop(f"{label}-best-{step}")
        step += 1
    if not step:
        return ranked.select("left", "right", "score")
    return workspace.rounds(f"{label}-taken").select("left", "right", "score")


def _seen_from(pairs: DataFrame, side: str) -> DataFrame:
    return pairs.select(F.lit(side).alias("side"), F.col(side).alias("name"), "*")


def _best(seen: DataFrame) -> DataFrame:
    rank = F.struct((-F.col("score")).alias("down"), "tie", "left", "right", "score")
    return (
        seen.groupBy("side", "name")
        .agg(F.min(rank).alias("best"))
        .select("side", "name", "best.left", "best.right", "best.score")
    )
