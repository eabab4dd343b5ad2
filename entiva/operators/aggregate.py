"""Aggregations over facts that carry an id, a name, or both."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.keys import key_present, only_keyed

ID, NAME = "id", "name"


def aggregate_by_key(
    df: DataFrame, key: str, measures: Mapping[str, Column], prefix: str = ""
) -> DataFrame:
    """Group the rows that have ``key``. Keyless rows are filtered before the shuffle."""
    aggregates = [measure.alias(prefix + name) for name, measure in measures.items()]
    return only_keyed(df, key).groupBy(key).agg(*aggregates)


def aggregate_by_either_key(
    df: DataFrame, id_column: str, name_column: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Group by id where there is one, else by name: two disjoint branches in one shuffle."""
    has_id = key_present(F.col(id_column))
    keyed = df.withColumns(
        {
            "key_type": F.when(has_id, F.lit(ID)).otherwise(F.lit(NAME)),
            "key": F.when(has_id, F.col(id_column)).otherwise(F.col(name_column)),
        }
    )
    return _by_typed_key(keyed, measures)


def aggregate_by_both_keys(
    df: DataFrame, id_column: str, name_column: str, measures: Mapping[str, Column]
) -> DataFrame:
    """Group every row by its id and again by its name, in one scan and one shuffle."""
    keys = F.array(
        F.struct(F.lit(ID).alias("key_type"), F.col(id_column).alias("key")),
        F.struct(F.lit(NAME).alias("key_type"), F.col(name_column).alias("key")),
    )
    keyed = df.withColumn("_keyed", F.explode(keys)).withColumns(
        {"key_type": F.col("_keyed.key_type"), "key": F.col("_keyed.key")}
    )
    return _by_typed_key(keyed, measures)


def _by_typed_key(keyed: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    aggregates = [measure.alias(name) for name, measure in measures.items()]
    return only_keyed(keyed, "key").groupBy("key_type", "key").agg(*aggregates)


def branch(aggregated: DataFrame, key_type: str, key_name: str) -> DataFrame:
    """One branch of a keyed aggregate, with its key under the given name."""
    return (
        aggregated.filter(F.col("key_type") == key_type)
        .withColumnRenamed("key", key_name)
        .drop("key_type")
    )
