"""Sinks: Parquet layers, catalog tables with declared types, and JDBC tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from entiva.session import hadoop_path, replace_text
from entiva.sources.readers import (
    current_version,
    layer_path,
    list_layer,
    pointer_path,
    read_layer,
    versions_path,
)

# Declared widths of text columns in warehouse tables; other text is wide
# where a database wants a width (JDBC) and unbounded in Parquet tables.
TEXT_WIDTHS = {"nome": 500, "nome_norm": 255, "cnpj_norm": 20, "segmento": 10}
WIDE_TEXT = 65535

#: Name of the column that holds the batch of a row, in tables that are loaded by batch.
BATCH = "lote"

# SQL type names of a warehouse table.
SQL_TYPES = {
    T.LongType(): "BIGINT",
    T.IntegerType(): "INTEGER",
    T.DoubleType(): "DOUBLE PRECISION",
    T.FloatType(): "REAL",
    T.BooleanType(): "BOOLEAN",
    T.TimestampType(): "TIMESTAMP",
}


def write_layer(df: DataFrame, base: str, layer: str, name: str) -> str:
    """Overwrite one Parquet dataset of a layer and return its path."""
    path = layer_path(base, layer, name)
    df.write.mode("overwrite").parquet(path)
    return path


def publish_layer(df: DataFrame, base: str, layer: str, name: str) -> str:
    """Write a new version of a dataset, then let the dataset's pointer file name it.

    Readers follow the pointer (``read_layer``), so they get the old version or the new one,
    whole, whenever a job fails or they look. The version that was current before stays for
    those who are reading it; older ones are deleted.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    folder = versions_path(base, layer, name)
    before = current_version(spark, base, layer, name)
    df.write.parquet(f"{folder}/{version}")
    replace_text(spark, pointer_path(base, layer, name), version)
    filesystem, versions = hadoop_path(spark, folder)
    for status in filesystem.listStatus(versions):
        if status.getPath().getName() not in (version, before):
            filesystem.delete(status.getPath(), True)
    if before is None:
        # files of a dataset that was not published are replaced as well
        for status in filesystem.listStatus(versions.getParent()):
            if not status.getPath().getName().startswith(("_", ".")):
                filesystem.delete(status.getPath(), True)
    return f"{folder}/{version}"


def text_type(name: str, widths: Mapping[str, int]) -> str:
    return f"VARCHAR({widths.get(name, WIDE_TEXT)})"


def jdbc_column_types(df: DataFrame, widths: Mapping[str, int] = TEXT_WIDTHS) -> str:
    """Column types for ``createTableColumnTypes``, derived from the frame's schema."""
    types = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            declared = text_type(field.name, widths)
        elif isinstance(field.dataType, T.DecimalType):
            declared = field.dataType.simpleString().upper()
        else:
            declared = SQL_TYPES.get(field.dataType, text_type(field.name, widths))
        types.append(f"`{field.name}` {declared}")
    return ", ".join(types)


def create_typed_table(
    df: DataFrame,
    table: str,
    path: str,
    widths: Mapping[str, int] = TEXT_WIDTHS,
    partition: str | None = None,
) -> None:
    """Create a Parquet catalog table if it is missing, with declared text widths; with
    ``partition``, a last text column of that name, by whose values it is stored."""
    columns = ", ".join(
        f"`{f.name}` "
        + (
            text_type(f.name, widths)
            if isinstance(f.dataType, T.StringType) and f.name in widths
            else f.dataType.simpleString()
        )
        for f in df.schema.fields
    )
    extra = f", `{partition}` STRING" if partition else ""
    stored = f" PARTITIONED BY (`{partition}`)" if partition else ""
    df.sparkSession.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}{extra}) USING parquet{stored} "
        f"LOCATION '{path}'"
    )


def load_table(
    df: DataFrame,
    table: str,
    path: str,
    mode: str = "overwrite",
    widths: Mapping[str, int] = TEXT_WIDTHS,
) -> None:
    """Create the table if needed and fill it. Text longer than declared fails the load."""
    create_typed_table(df, table, path, widths)
    df.write.insertInto(table, overwrite=mode == "overwrite")


def load_batch(
    df: DataFrame,
    table: str,
    path: str,
    batch: str,
    widths: Mapping[str, int] = TEXT_WIDTHS,
) -> None:
    """Append ``df`` as the batch of that name; a load that is repeated adds nothing.

    A batch is a partition of the table, in its last column ``BATCH``, and a load replaces
    its own partition only. So one that failed halfway is repaired by running it again, and
    batches can be loaded in any order or at the same time.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.:-]+", batch):
        raise ValueError(f"batch {batch!r} is not made of letters, digits and _.:-")
    if BATCH in df.columns:
        raise ValueError(f"the rows have a column {BATCH} of their own")
    spark = df.sparkSession
    create_typed_table(df, table, path, widths, partition=BATCH)
    if spark.table(table).columns != [*df.columns, BATCH]:
        raise ValueError(f"table {table} has other columns, or no batches")
    df.createOrReplaceTempView(view := f"batch_{uuid.uuid4().hex}")
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{BATCH}` = '{batch}') SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def load_layer(
    spark: SparkSession,
    base: str,
    layer: str,
    warehouse: str,
    *,
    prefix: str = "",
    mode: str = "overwrite",
    widths: Mapping[str, int] = TEXT_WIDTHS,
    batch: str | None = None,
) -> dict[str, str]:
    """Load every dataset of a layer into a table named after it; returns name to table.

    ``append`` adds the rows again on a rerun, as a bulk COPY does; ``overwrite`` is
    idempotent. ``append`` with the name of a ``batch`` is so too: see :func:`load_batch`.
    """
    if batch is not None and mode != "append":
        raise ValueError("a batch is appended; mode is not append")
    tables = {}
    for entry in list_layer(spark, base, layer):
        name = entry.removesuffix(".parquet")
        table = prefix + name
        stored = read_layer(spark, base, layer, entry)
        if batch is not None:
            load_batch(stored, table, f"{warehouse}/{name}", batch, widths)
        else:
            load_table(stored, table, f"{warehouse}/{name}", mode, widths)
        tables[name] = table
    return tables


def jdbc_write_options(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    keep_definition: bool,
    batch_rows: int,
    widths: Mapping[str, int] | None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **properties}
    if keep_definition:
        options["truncate"] = "true"
    if widths is not None:
        options["createTableColumnTypes"] = jdbc_column_types(df, widths)
    return options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "overwrite",
    keep_definition: bool = False,
    batch_rows: int = 1000,
    connections: int | None = None,
    widths: Mapping[str, int] | None = None,
) -> None:
    """Write to a JDBC table in parallel batches.

    ``overwrite`` drops and recreates the table; with ``keep_definition`` it truncates and
    loads instead. ``connections`` bounds the number of parallel writers.
    """
    if connections is not None:
        df = df.coalesce(connections)
    options = jdbc_write_options(
        df, url, table, properties,
        keep_definition=keep_definition, batch_rows=batch_rows, widths=widths,
    )
    df.write.format("jdbc").mode(mode).options(**options).save()
