"""Projections and schema shaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names and in mapping order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the first ``len(names)`` columns by position; later ones keep their names."""
    if len(df.columns) < len(names):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns: {df.columns}")
    return df.toDF(*names, *df.columns[len(names) :])


def column_at(df: DataFrame, position: int) -> Column:
    return F.col(f"`{df.columns[position]}`")


def add_constants(df: DataFrame, constants: Mapping[str, str | None]) -> DataFrame:
    """Add text columns with one value in every row; ``None`` gives a typed null."""
    return df.withColumns({k: F.lit(v).cast("string") for k, v in constants.items()})


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_in_order(frames: Iterable[DataFrame], order: Sequence[str]) -> DataFrame:
    """UNION ALL by position after putting every frame into the same column order."""
    return reduce(DataFrame.union, [df.select(*order) for df in frames])


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row holding the number of non-null values per column."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every row. Runs one aggregate over ``df``."""
    counts = non_null_counts(df).first().asDict()
    return df.drop(*[name for name, count in counts.items() if count == 0])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns that exist and ignore the others."""
    return df.withColumnsRenamed(dict(names))


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns that exist, in the given order."""
    return df.select(*[name for name in names if name in df.columns])


def fix_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to exact types; what does not fit becomes null (see ``cast_losses``)."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def cast_losses(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per run with, for each column, how many non-null values a cast would lose."""
    return df.agg(
        *[
            F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(name)
            for name, kind in types.items()
        ]
    )


def require_widths(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Fail the job on text longer than its declared width; nothing is cut silently."""
    checked = {}
    for name, width in widths.items():
        message = F.concat(F.lit(f"{name} exceeds {width} characters: "), F.col(name))
        too_long = F.length(name) > width
        checked[name] = F.when(too_long, F.raise_error(message)).otherwise(F.col(name))
    return df.withColumns(checked)


def width_report(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One row with, for each column, how many values exceed the declared width."""
    return df.agg(*[F.count_if(F.length(n) > w).alias(n) for n, w in widths.items()])
