"""The corpus pipeline: documents in, token ids of the documents worth keeping out.

Every stage takes all documents that the stage before it kept. Each result is written as
Parquet in the shared folder and read again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.llm import bpe, decontaminate, exact_dedup, language, near_dedup
from entiva.llm.common import fold, table, text_or_empty
from entiva.llm.queries import bpe_path
from entiva.session import Workspace

def key_name(docs: DataFrame) -> str:
    """Name of the key that tells rows apart where ids are repeated or missing; no column's."""
    name = "pipeline_row_key"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; texts without a letter and narrow leads go."""
    model = language.fit(docs, training=fold("doc_id", 4) != 2)
    found = language.predict(_keyed(docs), model, id_column=key_name(docs))
    return _without(docs, found.filter("rejected"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = key_name(docs)
    groups = exact_dedup.exact_groups(_keyed(docs), id_column=key)
    kept = _keyed(_without(docs, groups.filter("not kept")))
    # rows with one id and one text share a key, so a verdict; one of them stays
    repeated = kept.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1").select(key)
    once = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(once).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(_keyed(docs), id_column=key_name(docs))
    return _without(docs, groups.filter("not kept"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return _without(docs, decontaminate.contaminated(_keyed(docs), items, id_column=key_name(docs)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, bpe_path())


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of id and text, in the order of ids, null ones last."""
    text = text_or_empty("text")
    return docs.withColumn(
        key_name(docs),
        F.struct(
            F.col("doc_id").isNull().alias("no_id"),
            F.col("doc_id"),
            F.xxhash64(text).alias("text_hash"),
            F.length(text).alias("text_chars"),
        ),
    )


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """All columns of the documents whose key is no ``doc_id`` of ``gone``."""
    key = key_name(docs)
    keys = gone.select(F.col("doc_id").alias(key)).distinct()
    return _keyed(docs).join(keys, key, "left_anti").select(*docs.columns)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = workspace.keep(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


#: Compression and signatures cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None
