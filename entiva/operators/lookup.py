"""Joins that find at most one partner per row and never multiply rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.keys import key_present, only_keyed
from entiva.operators.dedup import keep_first

# Buckets over which the rows of one frequent (or missing) key are spread.
SPREAD = 64
# Keys reported as frequent: those holding at least 1 / FREQUENT_PARTS of all rows.
FREQUENT_PARTS = 200
NUL = "\u0000"


def frequent_keys(df: DataFrame, key: str, parts: int = FREQUENT_PARTS) -> list[str]:
    """Keys that hold about 1/``parts`` of all keyed rows or more: at most ``parts`` values.

    Uses a mergeable sketch, so a task sends a fixed-size summary. A false entry or a miss
    only changes how rows are spread, never a result.
    """
    keyed = only_keyed(df, key)
    summary = keyed.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {parts}, {parts * 50})").alias("top"),
    ).first()
    if not summary["n"]:
        return []
    threshold = max(summary["n"] / parts, 10_000)
    return [item["item"] for item in summary["top"] if item["count"] >= threshold]


def _left_text(left: DataFrame, key: str, frequent: Sequence[str]) -> Column:
    """The text a left row joins on.

    A missing key gives one of ``SPREAD`` texts that match nothing, a frequent key gets a
    salt appended, and every other key is used as it is. NUL separates the parts, so keys
    must not hold that character.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(SPREAD))
    text = F.col(key).cast("string")
    salted = F.when(~key_present(text), F.concat(F.lit(NUL), salt.cast("string")))
    if frequent:
        hot = text.isin(list(frequent))
        salted = salted.when(hot, F.concat(text, F.lit(NUL), salt.cast("string")))
    return salted.otherwise(text)


def _right_text(right: DataFrame, key: str, frequent: Sequence[str]) -> DataFrame:
    """The keyed right rows with their text; rows of frequent keys occur once per salt."""
    text = F.col(key).cast("string")
    keyed = only_keyed(right, key)
    if frequent:
        every_salt = F.transform(
            F.sequence(F.lit(0), F.lit(SPREAD - 1)),
            lambda i: F.concat(text, F.lit(NUL), i.cast("string")),
        )
        hot = text.isin(list(frequent))
        text = F.explode(F.when(hot, every_salt).otherwise(F.array(text)))
    return keyed.withColumn("_right_key", text).drop(key)


def _spread_join(
    left: DataFrame, rights: Sequence[DataFrame], key: str, how: str, frequent: Sequence[str]
) -> DataFrame:
    """Join on ``key`` with the rows of frequent and missing keys spread over many tasks.

    Several right sides share one shuffle of the left side.
    """
    joined = left.withColumn("_left_key", _left_text(left, key, frequent))
    for right in rights:
        keyed = _right_text(right, key, frequent)
        joined = joined.join(keyed, F.col("_left_key") == F.col("_right_key"), how)
        joined = joined.drop("_right_key")
    return joined.drop("_left_key")


def one_per_key(df: DataFrame, key: str, order: Sequence[Column | str] = ()) -> DataFrame:
    """The lookup side of a join: keyed rows only, one per key."""
    return keep_first(only_keyed(df, key), [key], order)


def lookup(
    left: DataFrame,
    *rights: DataFrame,
    key: str,
    right_is_unique: bool = False,
    order: Sequence[Column | str] = (),
    frequent: Sequence[str] = (),
) -> DataFrame:
    """Left join that adds the columns of at most one row of each right side.

    An empty or null key matches nothing. Whether a right side is broadcast is left to
    Spark, which goes by its measured size. Pass ``frequent_keys(left, key)`` as
    ``frequent`` when some keys may hold a large share of the left rows.
    """
    if not right_is_unique:
        rights = tuple(one_per_key(right, key, order) for right in rights)
    return _spread_join(left, rights, key, "left", frequent)


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key occurs on the right."""
    return only_keyed(left, key).join(only_keyed(right.select(key), key), key, "left_semi")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key does not occur on the right, with those that have no key."""
    return _spread_join(left, [right.select(key)], key, "left_anti", ())


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def first_present(df: DataFrame, choices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Set each output column to the first non-null of its inputs and drop the inputs."""
    filled = df.withColumns({out: F.coalesce(*inputs) for out, inputs in choices.items()})
    used = {c for inputs in choices.values() for c in inputs} - set(choices)
    return filled.drop(*used)


def matched_values(
    matches: DataFrame, candidates: DataFrame, name: str, columns: Sequence[str], prefix: str
) -> DataFrame:
    """The candidates' columns under the names they were matched to.

    ``matches`` holds ``name`` and ``candidate``, both unique; ``candidates`` holds ``name``
    (unique) and ``columns``. The result is a unique lookup side.
    """
    source = candidates.select(F.col(name).alias("candidate"), *columns)
    joined = matches.select(name, "candidate").join(source, "candidate")
    return prefixed(joined.drop("candidate"), prefix, columns)


def backfill(
    df: DataFrame,
    values: DataFrame,
    *,
    name: str,
    columns: Sequence[str],
    prefix: str,
    frequent: Sequence[str] = (),
) -> DataFrame:
    """Fill null ``columns`` of ``df`` from ``matched_values``; rows are never multiplied."""
    joined = lookup(df, values, key=name, right_is_unique=True, frequent=frequent)
    return first_present(joined, {c: [c, prefix + c] for c in columns})
