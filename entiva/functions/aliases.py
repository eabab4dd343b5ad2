"""Short names of institutions and the canonical name each stands for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# alias = canonical name, in their natural order.
INSTITUTION_ALIASES: dict[str, str] = {
    "BB": "BANCO DO BRASIL",
    "BANCO DO BRASIL": "BANCO DO BRASIL",
    "C6 BANK": "C6 BANK",
    "C6": "C6 BANK",
    "STONE": "STONE FINANCA",
    "NUBANK": "NUBANK",
    "XP": "XP INVESTIMENTOS",
    "INTER": "BANCO INTER",
    "BANCO INTER": "BANCO INTER",
    "NEON": "NEON PAGAMENTOS",
    "WILL": "BANCO WILL",
    "BANCO WILL": "BANCO WILL",
    "GM": "BANCO GM",
    "BANCO GM": "BANCO GM",
    "BMG": "BANCO BMG",
    "BANCO BMG": "BANCO BMG",
    "MODAL": "BANCO MODAL",
    "BANCO MODAL": "BANCO MODAL",
    "ORIGINAL": "BANCO ORIGINAL",
    "BANCO ORIGINAL": "BANCO ORIGINAL",
    "SAFRA": "BANCO SAFRA",
    "BANCO SAFRA": "BANCO SAFRA",
    "ITAU": "ITAU UNIBANCO",
    "ITAU UNIBANCO": "ITAU UNIBANCO",
    "BRADESCO": "BRADESCO",
    "SANTANDER": "SANTANDER",
    "CITIBANK": "CITIBANK",
    "BTG": "BTG PACTUAL",
    "BTG PACTUAL": "BTG PACTUAL",
    "ABC": "ABC BRASIL",
    "ABC BRASIL": "ABC BRASIL",
    "ABN AMRO": "BANCO ABN AMRO",
    "BANCO ABN AMRO": "BANCO ABN AMRO",
    "DAYCOVAL": "BANCO DAYCOVAL SA",
    "BANCO DAYCOVAL SA": "BANCO DAYCOVAL SA",
    "FATOR": "FATOR",
    "SICREDI": "SICREDI",
    "BANRISUL": "BANRISUL",
    "PAN": "BANCO PAN",
    "BANCO PAN": "BANCO PAN",
    "PINE": "PINE",
    "VOITER": "VOITER",
    "AGIBANK": "AGIBANK",
    "ALFA": "ALFA",
    "ANDBANK": "ANDBANK",
    "BANCOOB": "BANCOOB",
    "BANESTES": "BANESTES",
    "BARIGUI": "BARIGUI",
    "BOCOM": "BOCOM BBM",
    "BOM CREDITO": "BOM CREDITO SCMEPP",
    "BRB": "BRB BANCO DE BRASILIA",
    "BRB BANCO DE BRASILIA": "BRB BANCO DE BRASILIA",
    "CCB": "CCB BRASIL",
    "CCB BRASIL": "CCB BRASIL",
    "COBUCCIO": "COBUCCIO",
    "COLOMBO": "COLOMBO",
    "CREFISA": "CREFISA CFI",
    "CREFISA CFI": "CREFISA CFI",
    "FINAXIS": "FINAXIS",
    "GAZIN": "GAZINCRED SCFI",
    "GAZINCRED SCFI": "GAZINCRED SCFI",
    "GENIAL": "GENIAL INVESTIMENTOS",
    "HONDA": "HONDA",
    "INDUSVAL": "INDUSVAL",
    "LECCA": "LECCA",
    "MASTER": "MASTER",
    "MAXIMA": "MAXIMA CC",
    "NACIONAL": "BANCO NACIONAL",
    "OMNI": "OMNI",
    "RODOBENS": "RODOBENS",
    "SCANIA": "SCANIA",
    "SENFF": "SENFF CFI",
    "SENFF CFI": "SENFF CFI",
    "SIMPALA": "SIMPALA",
    "SOFISA": "SOFISA",
    "SOROCRED": "SOROCRED CFI",
    "SOROCRED CFI": "SOROCRED CFI",
    "SUMUP": "SUMUP",
    "UBS": "UBS BRASIL",
    "UBS BRASIL": "UBS BRASIL",
    "VOLKSWAGEN": "BANCO VOLKSWAGEN",
    "BANCO VOLKSWAGEN": "BANCO VOLKSWAGEN",
    "VR": "VR",
    "YAMAHA": "YAMAHA",
    "AFINZ": "AFINZ",
    "ASAAS": "ASAAS",
    "NEXT": "NEXT",
    "NEXT BANKO": "NEXT",
}


#: Aliases as a dictionary, or as a frame with ``nome`` and ``canonico`` if they are many.
Aliases = Mapping[str, str] | DataFrame


def alias_table(spark: SparkSession, aliases: Aliases | None = None) -> DataFrame:
    """The aliases as a two-column frame, ``nome`` and ``canonico``, one row per alias."""
    chosen = INSTITUTION_ALIASES if aliases is None else aliases
    if isinstance(chosen, DataFrame):
        return chosen.groupBy("nome").agg(F.min("canonico").alias("canonico"))
    return spark.createDataFrame(list(chosen.items()), "nome string, canonico string")


def resolve_aliases(
    df: DataFrame, name: str, output: str, aliases: Aliases | None = None
) -> DataFrame:
    """Add ``output``: the canonical form of ``name``, or ``name`` itself if it has none.

    Whether the aliases are broadcast is left to Spark, which knows their size.
    """
    table = alias_table(df.sparkSession, aliases).select(
        F.col("nome").alias("_alias"), F.col("canonico").alias("_canonical")
    )
    joined = df.join(table, F.col(name) == F.col("_alias"), "left")
    return joined.withColumn(output, F.coalesce("_canonical", name)).drop("_alias", "_canonical")
