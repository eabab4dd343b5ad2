"""Each operator as a query over its whole table, and in DuckDB SQL where that can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    language_model,
    line_dedup,
    merkle,
    near_dedup,
    phrases,
    secrets,
    statements,
    toxicity,
    url_filter,
)
from entiva.llm.common import fold, table

#: The vocabulary that the BPE query and the pipeline use; the operator takes any path.
BPE_FILE = "word_bpe_49k.json"


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE_FILE)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit(documents, training=fold("doc_id", 4) != 2)
    found = language.predict(documents, model)
    return found.withColumn("held_out", fold("doc_id", 4) == 2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels, training=fold("id", 5) != 0)
    found = toxicity.scores(documents, model)
    return found.withColumn("held_out", fold("doc_id", 5) == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), bpe_path(), digests=True)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    trie = language_model.train(documents, training=fold("doc_id", 10) != 0, order=3)
    found = language_model.scores(documents, trie)
    return found.withColumn("held_out", fold("doc_id", 10) == 0)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.secrets(documents, secrets.fit(documents)))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    gone = line_dedup.repeated_lines(documents)
    return line_dedup.report(documents, gone, "doc_id", "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


#: The rules of the URL query, host and start of path, and the words of unwanted domains.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
UNWANTED_WORDS = ["adult", "ads", "bets", "casino", "pills", "spam"]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    return url_filter.judge(pages, rules, url_filter.domains_with(pages, "url", UNWANTED_WORDS))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return merkle.manifest(documents, tampered=merkle.every_fifth()).drop("path")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_language_model": op4_language_model,
    "op5_decontamination": op5_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_secrets": op7_secrets,
    "op8_near_dedup": op8_near_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_url_filter": op11_url_filter,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op6_exact_dedup": r"""
with texts as (
    select doc_id, length(coalesce(text, '')) as chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
    from documents
), grouped as (
    select doc_id, text_sha256, count(*) over (partition by text_sha256) as group_size,
           first_value(doc_id) over (
               partition by text_sha256 order by chars desc, doc_id nulls last) as keep_id
    from texts
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from grouped
""",
    "op11_url_filter": statements.url_filter(URL_RULES, UNWANTED_WORDS),
    "op12_merkle_manifest": statements.merkle_manifest(fanout=16, levels=8),
    "op13_collocations": statements.collocations(least=30, most=2000),
}
