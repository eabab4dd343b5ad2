"""One row per key, chosen by an explicit order so that reruns agree.

The winner is the least ``struct`` of the ordering columns followed by all columns. A
``min`` aggregates partially before the shuffle, so each task sends at most one row per
key and a key that holds a third of the table does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.keys import key_present


def keep_first(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Keep, per key, the first row by ``order`` and then by all columns, ascending."""
    named_keys = [
        (F.col(k) if isinstance(k, str) else k).alias(f"_key{i}") for i, k in enumerate(keys)
    ]
    ranks = [
        (F.col(o) if isinstance(o, str) else o).alias(f"_rank{i}") for i, o in enumerate(order)
    ]
    row = F.struct(*ranks, *[F.col(c) for c in df.columns])
    return df.groupBy(*named_keys).agg(F.min(row).alias("_row")).select(
        *[F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def dedup_by_name(
    df: DataFrame, name: str = "nome_norm", order: Sequence[Column | str] = ()
) -> DataFrame:
    return keep_first(df, [name], order)


def dedup_by_key_priority(
    df: DataFrame,
    id_column: str = "cnpj_norm",
    name_column: str = "nome_norm",
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows with an id are unique by id, rows without one are unique by name: one shuffle."""
    has_id = key_present(F.col(id_column))
    kind = F.when(has_id, F.lit(1)).otherwise(F.lit(2))
    key = F.when(has_id, F.col(id_column)).otherwise(F.col(name_column))
    return keep_first(df, [kind, key], order)


def split_by_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the key, rows without it); together they are all of ``df``."""
    present = key_present(F.col(key))
    return df.filter(present), df.filter(~present)
