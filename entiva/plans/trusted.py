"""Raw text to trusted tables: canonical names, typed values, normalised keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.keys import normalize_id, normalize_name, normalize_name_by_pattern
from entiva.functions.numbers import parse_decimal_comma, to_double, to_long
from entiva.operators.shape import rename_positional, select_renamed

# Canonical column names of the three sources, by position.
REGISTRY_SOURCE = ["Segmento", "CNPJ", "Nome"]
REGISTRY_COLUMNS = ["segmento", "cnpj", "nome"]
RATING_COLUMNS = [
    "geral",
    "cultura_e_valores",
    "diversidade_e_inclusao",
    "qualidade_de_vida",
    "alta_lideranca",
    "remuneracao_e_beneficios",
    "oportunidades_de_carreira",
    "recomendam_pct",
    "perspectiva_pct",
]
REVIEW_PROFILE_COLUMNS = [
    "employer_name",
    "reviews_count",
    "culture_count",
    "salaries_count",
    "benefits_count",
    "employer_website",
    "employer_headquarters",
    "employer_founded",
    "employer_industry",
    "employer_revenue",
    "url",
]
REVIEW_COLUMNS = [
    *REVIEW_PROFILE_COLUMNS, *RATING_COLUMNS, "segmento", "nome", "match_percent", "cnpj"
]
COMPLAINT_COUNTS = [
    "qtd_reclamacoes_reguladas_procedentes",
    "qtd_reclamacoes_reguladas_outras",
    "qtd_reclamacoes_nao_reguladas",
    "qtd_total_reclamacoes",
    "qtd_total_clientes_ccs_e_scr",
    "qtd_clientes_ccs",
    "qtd_clientes_scr",
]
COMPLAINT_COLUMNS = [
    "ano", "trimestre", "categoria", "tipo", "cnpj_if", "instituicao_financeira", "indice",
    *COMPLAINT_COUNTS,
]
KEY_WIDTHS = {"nome_norm": 255, "cnpj_norm": 20}

NAME_RULES: dict[str, Callable[[Column], Column]] = {
    "literal": normalize_name,
    "pattern": normalize_name_by_pattern,
}


def with_keys(df: DataFrame, name: str, tax_id: str, rule: str = "literal") -> DataFrame:
    """Add ``nome_norm`` and ``cnpj_norm``. ``KEY_WIDTHS`` is checked once they are stored."""
    return df.withColumns(
        {"nome_norm": NAME_RULES[rule](F.col(name)), "cnpj_norm": normalize_id(F.col(tax_id))}
    )


def trusted_registry(raw: DataFrame, rule: str = "literal") -> DataFrame:
    renamed = select_renamed(raw, dict(zip(raw.columns, REGISTRY_COLUMNS)))
    return with_keys(renamed, "nome", "cnpj", rule)


def trusted_reviews(raw: DataFrame, rule: str = "literal") -> DataFrame:
    """Reviews with the 24 canonical columns first; ratings become doubles."""
    keyed = with_keys(rename_positional(raw, REVIEW_COLUMNS), "nome", "cnpj", rule)
    return keyed.withColumns({c: to_double(F.col(c)) for c in RATING_COLUMNS})


def trusted_complaints(raw: DataFrame, rule: str = "literal") -> DataFrame:
    """Complaints with the 14 canonical columns first; the index and counts become numbers."""
    keyed = with_keys(
        rename_positional(raw, COMPLAINT_COLUMNS), "instituicao_financeira", "cnpj_if", rule
    )
    return keyed.withColumns(
        {"indice": parse_decimal_comma(F.col("indice"))}
        | {c: to_long(F.col(c)) for c in COMPLAINT_COUNTS}
    )
