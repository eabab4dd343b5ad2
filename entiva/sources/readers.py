"""Scans: delimited text, Parquet layers and JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entiva.session import hadoop_path, read_text


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    *,
    sep: str,
    encoding: str = "UTF-8",
    escape: str = '"',
    phantom: str | None = None,
    glob: str | None = None,
    exclude: str | None = None,
    recursive: bool = False,
    provenance: str | None = None,
    provenance_from: Column | None = None,
    multi_line: bool = False,
    expected_header: Sequence[str] | None = None,
) -> DataFrame:
    """Read delimited files with a header line; every column is text, named by position.

    The explicit schema means no inference pass, and files of zero bytes give no rows.
    Blank lines are skipped and LF and CRLF both end a line. ``phantom`` names an extra last
    column, made by a trailing separator, which is dropped. ``glob`` keeps matching file
    names, ``exclude`` drops names that contain the text. ``provenance`` adds the name of
    the file each row came from, or ``provenance_from`` if another expression is wanted.
    ``multi_line`` lets quoted fields hold line breaks; a file is then one task.
    ``expected_header`` lists the names of the header line (with that of ``phantom``); a file
    with other names, or in another order, ends the job.
    """
    names = [*columns, phantom] if phantom else list(columns)
    if expected_header is not None:
        if len(expected_header) != len(names):
            raise ValueError(f"expected_header has {len(expected_header)} of {len(names)} names")
        names = list(expected_header)
    reader = (
        spark.read.schema(text_schema(names))
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", escape)
        .option("recursiveFileLookup", recursive)
        .option("multiLine", multi_line)
        .option("enforceSchema", expected_header is None)
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path if isinstance(path, str) else list(path))
    if exclude:
        df = df.filter(~F.col("_metadata.file_name").contains(exclude))
    kept: list[Column] = [
        F.col(f"`{name}`").alias(column) for name, column in zip(names, columns, strict=False)
    ]
    if provenance:
        source = F.col("_metadata.file_name") if provenance_from is None else provenance_from
        kept.append(source.alias(provenance))
    return df.select(*kept)


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def versions_path(base: str, layer: str, name: str) -> str:
    """Where a published dataset keeps its versions; hidden from readers of the folder."""
    return f"{layer_path(base, layer, name)}/_versions"


def pointer_path(base: str, layer: str, name: str) -> str:
    return f"{layer_path(base, layer, name)}/_current"


def current_version(spark: SparkSession, base: str, layer: str, name: str) -> str | None:
    """The version that the dataset's pointer names; None if it was never published."""
    return read_text(spark, pointer_path(base, layer, name))


def read_layer(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """A dataset of a layer: its current version if it was published, else its files."""
    version = current_version(spark, base, layer, name)
    if version is None:
        return spark.read.parquet(layer_path(base, layer, name))
    return spark.read.parquet(f"{versions_path(base, layer, name)}/{version}")


def list_layer(spark: SparkSession, base: str, layer: str) -> list[str]:
    """Names of the Parquet datasets in a layer, from one directory listing.

    A dataset is a folder, or a file ending in ``.parquet``; the suffix is not part of its
    name. Hidden and underscore entries are skipped.
    """
    filesystem, folder = hadoop_path(spark, f"{base.rstrip('/')}/{layer}")
    names = []
    for status in filesystem.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if status.isDirectory() or name.endswith(".parquet"):
            names.append(name)
    return sorted(names)


@dataclass(frozen=True)
class JdbcSplit:
    """How to read one JDBC table in parallel: a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


def jdbc_read_options(
    url: str, table: str, properties: Mapping[str, str], split: JdbcSplit | None, fetch_rows: int
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **properties}
    return options | split.options() if split else options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    split: JdbcSplit | None = None,
    in_one_task: bool = False,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Scan a JDBC table. Select and filter the result: both are pushed into its query.

    Without a ``split`` the whole table would go through one task, which must be asked for.
    """
    if split is None and not in_one_task:
        raise ValueError("give a split, or in_one_task=True for a small table")
    options = jdbc_read_options(url, table, properties, split, fetch_rows)
    return spark.read.format("jdbc").options(**options).load()
