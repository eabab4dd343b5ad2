"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition is a run: its rows reduced to one entry per digest, in digest order.
In each round ``fan_in`` neighbouring runs meet and are merged into one, so after
``log(runs) / log(fan_in)`` rounds one run is left. An entry carries the size of its group
and the row that stays, so what is exchanged never grows with the number of copies: a text
that a third of all rows share sends one entry per run.

Equal digests alone merge nothing: an entry is keyed by SHA-256 and by two facts that do not
depend on it (length and a 64-bit hash of the normalised text), checked at every level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import attach, text_or_empty, without_blanks
from entiva.session import Workspace

KEY = ["text_sha256", "norm_chars", "norm_hash"]


def digests(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id, length, digest and run (input partition) of every row."""
    text = text_or_empty(text_column)
    return (
        documents.select(F.col(id_column).alias("doc_id"), text.alias("text"))
        .select("doc_id", F.length("text").alias("chars"), without_blanks(F.col("text")).alias("n"))
        .select(
            "doc_id",
            "chars",
            F.sha2("n", 256).alias("text_sha256"),
            F.length("n").alias("norm_chars"),
            F.xxhash64("n").alias("norm_hash"),
            F.spark_partition_id().alias("run"),
        )
    )


def merge_runs(rows: DataFrame, runs: int, fan_in: int = 16) -> DataFrame:
    """One entry per digest: the row that stays and the group's size.

    Longest original text first, then the smallest id; a null id comes last.
    """
    best = F.min("best").alias("best")
    size = F.sum("group_size").alias("group_size")
    merged = rows.select(
        *KEY,
        "run",
        F.struct(
            (-F.col("chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id"
        ).alias("best"),
        F.lit(1).cast("long").alias("group_size"),
    )
    merged = merged.groupBy(*KEY, "run").agg(best, size)
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        merged = merged.groupBy(*KEY, "run").agg(best, size)
    return merged.select(*KEY, F.col("best.doc_id").alias("keep_id"), "group_size")


def exact_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    fan_in: int = 16,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too.

    Texts are equal when identical without white space; null counts as empty, and empty
    texts form one group like any other. Of equal texts the longest original stays, then the
    smallest id (null last). Repeated rows with one id share their verdict. An empty table
    gives no rows; other columns are ignored. Digests are written to the shared folder.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    rows = workspace.keep(digests(documents, id_column, text_column), "digests")
    last = rows.agg(F.max("run")).first()[0]
    groups = workspace.keep(merge_runs(rows, (last or 0) + 1, fan_in), "digest_groups")
    return attach(rows, groups, KEY).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
