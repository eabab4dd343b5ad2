"""Matching names that are not equal: aliases first, then similarity.

Candidates for an edit distance come from signatures of segments (``operators/segments.py``),
which lose no pair at any cutoff; only pairs that meet under one are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.functions.aliases import Aliases, resolve_aliases
from entiva.functions.keys import only_keyed
from entiva.functions.similarity import (
    levenshtein_allowance,
    levenshtein_score,
    unlike_letters,
)
from entiva.operators.assign import one_to_one
from entiva.operators.segments import candidates
from entiva.session import Workspace

# Gram counts are kept per hash bucket, so the broadcast table has a fixed size.
FREQUENCY_BUCKETS = 65_536
# A canonical text with more names than this is numbered in several tasks.
STRETCH_NAMES = 100_000
# Cutoffs tried from strict to loose: only names without a strict match meet the loose one.
STRICT_STEPS = (90,)


# A one-to-one matcher: (left, right, cutoff, workspace, label) to left, right and score.
Matcher = Callable[[DataFrame, DataFrame, int, Workspace, str], DataFrame]


def distinct_names(df: DataFrame, name: str, aliases: Aliases | None = None) -> DataFrame:
    """Distinct non-empty names with the text to compare: their canonical form."""
    names = only_keyed(df.select(F.col(name).alias("name")), "name").distinct()
    return resolve_aliases(names, "name", "text", aliases)


def exact_canonical_pairs(
    left: DataFrame, right: DataFrame, workspace: Workspace | None = None, label: str = "equal"
) -> DataFrame:
    """Pair names with equal canonical text, first with first in name order.

    Names are numbered within their text and paired by number, so however many aliases a
    canonical name has, none is gathered into an array.
    """
    workspace = workspace or Workspace(left.sparkSession)
    lefts = placed(left, workspace, f"{label}-left").withColumnRenamed("name", "left")
    rights = placed(right, workspace, f"{label}-right").withColumnRenamed("name", "right")
    return lefts.join(rights, ["text", "place"]).select("left", "right")


def placed(
    names: DataFrame, workspace: Workspace, label: str, stretch_names: int = STRETCH_NAMES
) -> DataFrame:
    """``text, name, place``: the number, from 1, of each name among those of its text.

    A text with over ``stretch_names`` names is not numbered in one task: its names are dealt
    into stretches by range of name, numbered within them, and moved by the sizes of the
    stretches before. What meets per text are the sizes, one number a stretch. Stretches are
    written, so that a lost executor cannot deal them anew.
    """
    by_name = Window.partitionBy("text").orderBy("name")
    sizes = names.groupBy("text").agg(F.count(F.lit(1)).alias("names"))
    large = workspace.keep(sizes.filter(F.col("names") > stretch_names), f"{label}-large")
    total = large.agg(F.sum("names")).first()[0]
    if total is None:
        return names.select("text", "name", F.row_number().over(by_name).cast("long").alias("place"))
    small = names.join(large.select("text"), "text", "left_anti").select(
        "text", "name", F.row_number().over(by_name).cast("long").alias("place")
    )
    dealt = workspace.keep(
        names.select("text", "name")
        .join(large.select("text"), "text", "left_semi")
        .repartitionByRange(total // stretch_names + 1, "text", "name")
        .withColumn("stretch", F.spark_partition_id()),
        f"{label}-stretches",
    )
    before = Window.partitionBy("text").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        dealt.groupBy("text", "stretch")
        .agg(F.count(F.lit(1)).alias("names"))
        .select("text", "stretch", F.coalesce(F.sum("names").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("text", "stretch").orderBy("name"))
    spread = (
        dealt.withColumn("within", within)
        .join(offsets, ["text", "stretch"])
        .select("text", "name", (F.col("offset") + F.col("within")).alias("place"))
    )
    return small.unionByName(spread)


def numbered(grams: Column) -> Column:
    """Keys for an array of grams; the k-th repeat of a gram gets a key of its own."""
    return F.transform(
        grams,
        lambda gram, i: F.xxhash64(
            gram, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda other: other == gram))
        ),
    )


def spread_names(names: DataFrame) -> DataFrame:
    """Names spread by name and text, so that regrouping their grams needs no shuffle.

    Work per name is heavy and the table is small, so the partition count is set here
    instead of being coalesced by size.
    """
    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(parts, "name", "text")


def bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(FREQUENCY_BUCKETS))


def gram_frequencies(grams: DataFrame) -> DataFrame:
    """How often the grams of each hash bucket occur; at most ``FREQUENCY_BUCKETS`` rows."""
    return grams.groupBy(bucket(F.col("gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def levenshtein_pairs(
    left: DataFrame, right: DataFrame, cutoff: int, workspace: Workspace, label: str
) -> DataFrame:
    """Every pair of names whose texts score ``cutoff`` or more, once each.

    ``left`` and ``right`` hold distinct ``name`` and the ``text`` to compare. The edit distance
    is a condition on the candidates, which are texts; only true matches are given their names.
    """
    if not 0 <= cutoff <= 100:
        raise ValueError(f"cutoff {cutoff} is not between 0 and 100")
    pairs = comparable(candidates(left, right, cutoff, workspace, label), cutoff)
    longer = _longer()
    distance = F.call_function(
        "levenshtein", F.col("left_text"), F.col("right_text"), levenshtein_allowance(longer, cutoff)
    )
    found = (
        pairs.filter(distance >= 0)
        .select("left_text", "right_text", levenshtein_score(distance, longer).alias("score"))
        .distinct()
    )
    for side, names in (("left", left), ("right", right)):
        named = names.select(F.col("name").alias(side), F.col("text").alias(f"{side}_text"))
        found = found.join(named, f"{side}_text")
    return found.select("left", "right", "score")


def _longer() -> Column:
    return F.greatest(F.length("left_text"), F.length("right_text"))


def comparable(pairs: DataFrame, cutoff: int) -> DataFrame:
    """Candidates whose letters do not rule them out: with ``d`` edits, of which the difference
    in length takes its share, no more than ``2 d`` letters are unlike."""
    gap = F.abs(F.length("left_text") - F.length("right_text"))
    unlike = unlike_letters(F.col("left_marks"), F.col("right_marks"))
    return pairs.filter(unlike <= 2 * levenshtein_allowance(_longer(), cutoff) - gap)


def best_per_left(pairs: DataFrame) -> DataFrame:
    """The best candidate of every left name: highest score, then first in name order."""
    rank = F.struct((-F.col("score")).alias("down"), "right", "score")
    return pairs.groupBy("left").agg(F.min(rank).alias("best")).select(
        "left", F.col("best.right").alias("right"), F.col("best.score").alias("score")
    )


def match_names(
    left: DataFrame,
    right: DataFrame,
    *,
    name: str,
    cutoff: int,
    workspace: Workspace,
    label: str,
    aliases: Aliases | None = None,
    matcher: Matcher | None = None,
) -> DataFrame:
    """Give each distinct left name at most one right name; no right name is given twice.

    Equal canonical names are paired first. Then ``matcher`` pairs similar names, best
    first; the default scores by edit distance. Returns ``name``, ``candidate``, ``kind``
    (alias or similar) and ``score``.
    """
    lefts = workspace.keep(distinct_names(left, name, aliases), f"{label}-left")
    rights = workspace.keep(distinct_names(right, name, aliases), f"{label}-right")
    exact = workspace.keep(
        exact_canonical_pairs(lefts, rights, workspace, f"{label}-equal").withColumn(
            "score", F.lit(100.0)
        ),
        f"{label}-alias",
    )
    similar = (matcher or levenshtein_matcher)(
        without(lefts, exact, "left"), without(rights, exact, "right"), cutoff, workspace, label
    )
    return (
        exact.withColumn("kind", F.lit("alias"))
        .unionByName(similar.withColumn("kind", F.lit("similar")))
        .select(F.col("left").alias(name), F.col("right").alias("candidate"), "kind", "score")
    )


def levenshtein_matcher(
    left: DataFrame, right: DataFrame, cutoff: int, workspace: Workspace, label: str
) -> DataFrame:
    """One-to-one matching by edit distance, in steps from strict to loose cutoffs.

    All pairs of a step score more than any pair that only a later step finds, so the steps
    give what one best-first pass over all pairs would, but only names without a strict
    match take part in the costly loose step.
    """
    steps = [s for s in STRICT_STEPS if s > cutoff] + [cutoff]
    return match_in_steps(
        left,
        right,
        [
            lambda a, b, step=step: one_to_one(
                levenshtein_pairs(a, b, step, workspace, f"{label}-{step}"),
                workspace,
                f"{label}-{step}",
            )
            for step in steps
        ],
        workspace,
        label,
    )


def match_in_steps(
    left: DataFrame,
    right: DataFrame,
    steps: Sequence[Callable[[DataFrame, DataFrame], DataFrame]],
    workspace: Workspace,
    label: str,
) -> DataFrame:
    """Run one-to-one steps in turn, each over the names that earlier steps left open."""
    found: list[DataFrame] = []
    for number, step in enumerate(steps):
        if found:
            left, right = without(left, found[-1], "left"), without(right, found[-1], "right")
        left = workspace.keep(left, f"{label}-open-left-{number}")
        right = workspace.keep(right, f"{label}-open-right-{number}")
        pairs = step(left, right) if not (left.isEmpty() or right.isEmpty()) else None
        if pairs is None:
            break
        found.append(pairs.withColumn("score", F.col("score").cast("double")))
    if not found:
        return left.sparkSession.createDataFrame([], "left string, right string, score double")
    return reduce(DataFrame.unionByName, found)


def without(names: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    return names.join(pairs.select(F.col(side).alias("name")), "name", "left_anti")
