"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold(of: str | Column, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; a null id counts as the empty text."""
    value = F.col(of) if isinstance(of, str) else of
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")) % parts


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; no other character changes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Groups with more than this share of all rows are joined by broadcast: at most its inverse.
HEAVY_SHARE = 0.001


def attach(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one row per key, and in
    ``group_size`` the number of rows that have it.

    Rows of a large group would meet in one task of a shuffled join. There are few such groups
    (at most 1 / HEAVY_SHARE), so they are broadcast; the others are joined by a shuffle.
    """
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    heavy = F.col("group_size") > max(1, int(total * HEAVY_SHARE))
    few = F.broadcast(groups.filter(heavy))
    rest = rows.join(few.select(*key), key, "left_anti").join(groups.filter(~heavy), key)
    return rows.join(few, key).unionByName(rest)


#: Rows that are sent to a Python worker, and looked at there, at a time.
BATCH_ROWS = 256
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Actions inside send their Python workers batches of at most ``rows`` rows, so that what
    both sides hold of whole texts does not depend on the session's setting."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, where the caller set no smaller ones."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for their Python workers."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="entiva-")) / "entiva.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
