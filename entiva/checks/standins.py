"""The given tables reshaped into a registry, complaints and reviews, all columns text.

Names come from a digest of the key, so that different institutions have clearly
different names, as real ones do; some complaints and reviews spell them with letters
missing, and some ids are zero, blank or zero-padded. ``checks/oracle.py`` states the same
shapes in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.plans.layers import NO_DATA, REVIEWS_WITH_ID, REVIEWS_WITH_SEGMENT, SourceFiles
from entiva.plans.trusted import (
    COMPLAINT_COLUMNS,
    RATING_COLUMNS,
    REGISTRY_SOURCE,
    REVIEW_PROFILE_COLUMNS,
)
from entiva.session import Workspace, hadoop_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def institution(key: Column, dropped: Column | int = 0) -> Column:
    """Name of an institution, with the last ``dropped`` letters missing."""
    kinds = F.element_at(
        F.array(*[F.lit(k) for k in ("Banco ", "Crédito ", "Cooperativa ", "Instituição ")]),
        (key % 4 + 1).cast("int"),
    )
    length = F.lit(14) - dropped
    return F.concat(kinds, F.upper(F.substring(F.md5(_text(key)), F.lit(1), length)))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a registry; every fiftieth is listed twice under two legal forms."""
    key = F.col("c_custkey")
    suffixes = F.array(*[F.lit(s) for s in (" - PRUDENCIAL", " S.A.", " LTDA", " S/A", "")])
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    name = F.when(key == 10, "Banco do Brasil").when(key == 12, "Itaú Unibanco").otherwise(
        institution(key)
    )
    listed = table(spark, sf_dir, "customer").withColumn("copy", F.explode(copies))
    suffix = F.element_at(suffixes, ((key + F.col("copy")) % 5 + 1).cast("int"))
    return listed.select(
        F.col("c_mktsegment").alias("Segmento"),
        F.when(key % 7 == 0, "0").otherwise(_text(key)).alias("CNPJ"),
        F.concat(name, suffix).alias("Nome"),
    ).select(*REGISTRY_SOURCE)


def contested_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry, and beside some institutions one without an id whose name differs in the
    last letter: both are as near to a name that is cut short, in complaints or in reviews."""
    key = F.col("c_custkey")
    rivals = table(spark, sf_dir, "customer").filter((key % 22 == 14) | (key % 9 == 4))
    return registry(spark, sf_dir).unionByName(
        rivals.select(
            F.lit("RIVAL").alias("Segmento"),
            F.lit("0").alias("CNPJ"),
            F.concat(institution(key, 1), F.lit("Z")).alias("Nome"),
        )
    )


def complaints(spark: SparkSession, sf_dir: str, contested: bool = False) -> DataFrame:
    """Orders as complaints: half of the customers without an id, some names cut short; if
    ``contested``, some of these cut further in every other complaint."""
    order, key = F.col("o_orderkey"), F.col("o_custkey")
    further = F.lit(contested) & (key % 22 == 14) & (order % 2 == 0)
    dropped = F.when(further, 2).when(key % 11 == 3, 1).when(key % 11 == 5, 3).otherwise(0)
    name = F.when(key == 10, "BB").when(key == 12, "Itaú").otherwise(institution(key, dropped))
    index = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")
    upheld, other, free = order % 7, order % 5, order % 3
    total = _text(upheld + other + free)
    values = {
        "ano": _text(F.year("o_orderdate")),
        "trimestre": _text(F.quarter("o_orderdate")),
        "categoria": F.col("o_orderpriority"),
        "tipo": F.col("o_orderstatus"),
        "cnpj_if": F.when(key % 2 == 0, " ").otherwise(F.lpad(_text(key), 8, "0")),
        "instituicao_financeira": F.concat(name, F.lit(" (conglomerado)")),
        "indice": F.when(order % 13 == 0, " ").otherwise(index),
        "qtd_reclamacoes_reguladas_procedentes": _text(upheld),
        "qtd_reclamacoes_reguladas_outras": _text(other),
        "qtd_reclamacoes_nao_reguladas": _text(free),
        "qtd_total_reclamacoes": F.when(order % 101 == 0, "x")
        .when(order % 4 == 0, F.concat(total, F.lit(".0")))
        .otherwise(total),
        "qtd_total_clientes_ccs_e_scr": F.when(order % 10 == 0, "0").otherwise(
            _text(order % 97 * 1000)
        ),
        "qtd_clientes_ccs": _text(order % 11),
        "qtd_clientes_scr": _text(order % 17),
    }
    return table(spark, sf_dir, "orders").select(*[values[c].alias(c) for c in COMPLAINT_COLUMNS])


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    cents = F.round(F.abs("s_acctbal") * 100).cast("bigint")
    values = {c: F.concat(F.lit(c + " "), _text(key)) for c in REVIEW_PROFILE_COLUMNS}
    for i, name in enumerate(RATING_COLUMNS):
        tenths = (cents + F.lit(3 * i)) % 41 + 10
        rating = F.concat(_text(F.floor(tenths / 10)), F.lit("."), _text(tenths % 10))
        values[name] = F.when((key + i) % 13 == 0, "").otherwise(rating) if i else rating
    values |= {
        "segmento": F.concat(F.lit("S"), _text(key % 5)),
        "cnpj": F.lpad(_text(key), 8, "0"),
        "nome": institution(key, F.when(key % 9 == 4, 1).otherwise(0)),
        "match_percent": _text(key % 101),
    }
    return table(spark, sf_dir, "supplier").select(key, *[v.alias(k) for k, v in values.items()])


def reviews_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir).filter(F.col("s_suppkey") % 5 != 0).select(*REVIEWS_WITH_SEGMENT)


def reviews_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    chosen = (key % 5 == 0) | (key % 20 == 1)
    return _reviews(spark, sf_dir).filter(chosen).select(*REVIEWS_WITH_ID)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str,
    encoding: str = "UTF-8",
    escape: str = '"',
    by: str | None = None,
) -> None:
    writer = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
    )
    (writer.partitionBy(by) if by else writer).csv(path)


def add_files_without_data(spark: SparkSession, folder: str) -> None:
    """A file of zero bytes and a file that the name rule leaves out."""
    filesystem, _ = hadoop_path(spark, folder)
    for name, content in (("empty.csv", b""), (f"2022_{NO_DATA}.csv", b"header\nnot data\n")):
        _, target = hadoop_path(spark, f"{folder}/{name}")
        stream = filesystem.create(target, True)
        stream.write(bytearray(content))
        stream.close()


def label_of_file() -> Column:
    """The label of a text file, taken from the folder that holds its parts."""
    return F.regexp_extract("_metadata.file_path", "arquivo=([^/]+)/", 1)


def write_source_files(spark: SparkSession, sf_dir: str, workspace: Workspace) -> SourceFiles:
    """The stand-ins as delimited files in the formats the pipeline reads."""
    files = SourceFiles(
        registry=workspace.folder("files/registry"),
        reviews_with_segment=workspace.folder("files/reviews-segment"),
        reviews_with_id=workspace.folder("files/reviews-id"),
        complaints=workspace.folder("files/complaints"),
        recursive=True,
        provenance_from=label_of_file(),
    )
    write_delimited(registry(spark, sf_dir), files.registry, "\t")
    write_delimited(reviews_with_segment(spark, sf_dir), files.reviews_with_segment, "|")
    write_delimited(reviews_with_id(spark, sf_dir), files.reviews_with_id, "|")
    by_quarter = complaints(spark, sf_dir).withColumns(
        {
            "_trailing": F.lit(None).cast("string"),
            "arquivo": F.concat("ano", F.lit("_tri_0"), "trimestre"),
        }
    )
    write_delimited(by_quarter, files.complaints, ";", "ISO-8859-1", by="arquivo")
    add_files_without_data(spark, files.complaints)
    return files
