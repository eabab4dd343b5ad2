"""Data-quality and result reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.keys import key_present
from entiva.operators.lookup import matched


def layer_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def coverage(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows in total, with each of two columns, and with both: one pass."""
    both = F.col(first).isNotNull() & F.col(second).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(first).alias("n_first"),
        F.count(second).alias("n_second"),
        F.count_if(both).alias("n_both"),
    )


def key_completeness(df: DataFrame, key: str) -> DataFrame:
    missing = ~key_present(F.col(key))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(missing).alias("n_missing"),
        F.avg(F.when(missing, 1).otherwise(0)).alias("share_missing"),
    )


# Fixed value: the character that decoders put in place of what they could not read.
REPLACEMENT = "�"


def replacement_chars(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lost characters per column: how many, and in how many rows. One pass over ``df``."""
    def lost(name: str) -> Column:
        return F.length(name) - F.length(F.replace(F.col(name), F.lit(REPLACEMENT), F.lit("")))

    counted = df.agg(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.coalesce(F.sum(lost(name)), F.lit(0)).cast("bigint").alias("n_lost"),
                F.count_if(lost(name) > 0).alias("n_rows"),
            ).alias(name)
            for name in columns
        ]
    )
    return counted.select(F.inline(F.array(*columns)))


def match_uplift(
    registry: DataFrame, facts: DataFrame, rules: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Per key rule, how many distinct registry keys occur among the facts.

    A rule is (registry key expression, fact key expression).
    """
    counted = []
    for name, (left_key, right_key) in rules.items():
        left = registry.select(left_key.alias("key")).distinct()
        right = facts.select(right_key.alias("key")).distinct()
        counted.append(
            matched(left, right, "key")
            .agg(F.count(F.lit(1)).alias("n_matched"))
            .select(F.lit(name).alias("rule"), "n_matched")
        )
    return reduce(DataFrame.unionByName, counted)


def ranked(
    df: DataFrame,
    *,
    required: Sequence[str],
    by: str,
    then: str,
    columns: Sequence[Column | str],
    limit: int | None = None,
) -> DataFrame:
    """Rows with all ``required`` columns, highest ``by`` first, ties in ``then`` order."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    rows = df.filter(present).orderBy(F.desc(by), F.asc(then)).select(*columns)
    return rows if limit is None else rows.limit(limit)
