"""The master table: one row per institution, with complaint figures and ratings."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.aliases import Aliases
from entiva.functions.keys import key_present, only_keyed
from entiva.functions.numbers import exact_mean, ratio
from entiva.operators.aggregate import (
    ID,
    NAME,
    aggregate_by_both_keys,
    aggregate_by_either_key,
    branch,
)
from entiva.operators.dedup import dedup_by_key_priority, dedup_by_name
from entiva.operators.lookup import (
    first_present,
    frequent_keys,
    lookup,
    matched_values,
    one_per_key,
    prefixed,
    unmatched,
)
from entiva.operators.match import Matcher, match_names
from entiva.operators.shape import select_renamed
from entiva.plans.trusted import RATING_COLUMNS
from entiva.session import Workspace

TAX_ID, NAME_KEY = "cnpj_norm", "nome_norm"

# Lowest similarity at which complaint and review names are matched.
COMPLAINT_CUTOFF = 80
REVIEW_CUTOFF = 90

# Columns of the two layouts of the master table.
FULL_METRICS = [
    "qtd_total_reclamacoes", "qtd_procedentes", "indice_medio", "trimestres_com_reclamacao",
]
FULL_RATINGS = {
    "geral": "nota_geral",
    "cultura_e_valores": "nota_cultura",
    "diversidade_e_inclusao": "nota_diversidade",
    "qualidade_de_vida": "nota_qualidade_vida",
    "alta_lideranca": "nota_lideranca",
    "remuneracao_e_beneficios": "nota_remuneracao",
    "oportunidades_de_carreira": "nota_carreira",
    "recomendam_pct": "pct_recomendam",
    "perspectiva_pct": "pct_perspectiva",
}
INDICATOR_METRICS = [
    "reclamacao_total",
    "reclamacao_indice_bacen",
    "reclamacao_trimestres",
    "reclamacao_indice_calculado",
    "reclamacao_pct_procedentes",
]
INDICATOR_RATINGS = {
    "geral": "avaliacao_geral",
    "cultura_e_valores": "avaliacao_cultura",
    "diversidade_e_inclusao": "avaliacao_diversidade",
    "qualidade_de_vida": "avaliacao_qualidade_vida",
    "alta_lideranca": "avaliacao_lideranca",
    "remuneracao_e_beneficios": "avaliacao_remuneracao",
    "oportunidades_de_carreira": "avaliacao_carreira",
    "recomendam_pct": "avaliacao_recomendam_pct",
    "perspectiva_pct": "avaliacao_perspectiva_pct",
}


def complaint_measures() -> dict[str, Column]:
    """Totals per key. The last one counts rows, which is one per quarter and category."""
    return {
        "qtd_total_reclamacoes": F.sum("qtd_total_reclamacoes"),
        "qtd_procedentes": F.sum("qtd_reclamacoes_reguladas_procedentes"),
        "indice_medio": exact_mean(F.col("indice")),
        "trimestres_com_reclamacao": F.count(F.lit(1)),
    }


def indicator_measures() -> dict[str, Column]:
    return {
        "reclamacao_total": F.sum("qtd_total_reclamacoes"),
        "reclamacao_indice_bacen": exact_mean(F.col("indice")),
        "reclamacao_trimestres": F.countDistinct("trimestre"),
        "total_clientes": F.sum("qtd_total_clientes_ccs_e_scr"),
        "total_procedentes": F.sum("qtd_reclamacoes_reguladas_procedentes"),
    }


def with_indicator_ratios(aggregated: DataFrame) -> DataFrame:
    """Complaints per customer and share upheld; a zero denominator gives null."""
    total = F.col("reclamacao_total")
    return aggregated.withColumns(
        {
            "reclamacao_indice_calculado": ratio(total, F.col("total_clientes")),
            "reclamacao_pct_procedentes": ratio(F.col("total_procedentes"), total),
        }
    )


class _Builder:
    """The steps both layouts share: deduplicate, look up by id and name, match, fill."""

    def __init__(
        self,
        registry: DataFrame,
        reviews: DataFrame,
        metrics: DataFrame,
        metric_names: Sequence[str],
        workspace: Workspace | None,
        aliases: Aliases | None,
        dedup_registry_by: str,
        matcher: Matcher | None,
    ):
        self.spark = registry.sparkSession
        self.workspace = workspace or Workspace(self.spark)
        self.aliases = aliases
        self.matcher = matcher
        self.metric_names = list(metric_names)
        self.registry = (
            dedup_by_name(registry, NAME_KEY)
            if dedup_registry_by == "name"
            else dedup_by_key_priority(registry, TAX_ID, NAME_KEY)
        )
        self.frequent = frequent_keys(registry, NAME_KEY)
        # Both are far smaller than the facts and are read by several steps.
        self.metrics = self.workspace.keep(metrics, "metrics", by="key_type")
        self.reviews = self.workspace.keep(
            dedup_by_key_priority(
                reviews.select(TAX_ID, NAME_KEY, *RATING_COLUMNS), TAX_ID, NAME_KEY
            ),
            "reviews",
        )
        self.metrics_by_id = branch(self.metrics, ID, TAX_ID).select(TAX_ID, *self.metric_names)
        self.metrics_by_name = branch(self.metrics, NAME, NAME_KEY).select(
            NAME_KEY, *self.metric_names
        )
        self.reviews_by_id = only_keyed(self.reviews, TAX_ID).drop(NAME_KEY)
        # A name may occur with an id and without one; the row with an id wins.
        self.reviews_by_name = one_per_key(
            self.reviews, NAME_KEY, order=[~key_present(F.col(TAX_ID))]
        ).drop(TAX_ID)

    def exact(self, metrics_by_name: bool) -> DataFrame:
        """Registry rows with what equal ids and equal names give, written once."""
        by_id = lookup(
            self.registry,
            prefixed(self.metrics_by_id, "c_", self.metric_names),
            prefixed(self.reviews_by_id, "rc_", RATING_COLUMNS),
            key=TAX_ID,
            right_is_unique=True,
        )
        by_name = [prefixed(self.reviews_by_name, "rn_", RATING_COLUMNS)]
        choices = {c: ["c_" + c] for c in self.metric_names}
        if metrics_by_name:
            by_name.append(prefixed(self.metrics_by_name, "n_", self.metric_names))
            choices = {c: ["c_" + c, "n_" + c] for c in self.metric_names}
        joined = lookup(
            by_id, *by_name, key=NAME_KEY, right_is_unique=True, frequent=self.frequent
        )
        filled = first_present(
            joined, choices | {c: ["rc_" + c, "rn_" + c] for c in RATING_COLUMNS}
        )
        return self.workspace.keep(filled, "exact")

    def match(
        self, rows: DataFrame, missing: str, candidates: DataFrame, cutoff: int, label: str
    ) -> DataFrame:
        return match_names(
            rows.filter(F.col(missing).isNull()).select(NAME_KEY),
            candidates.select(NAME_KEY),
            name=NAME_KEY,
            cutoff=cutoff,
            aliases=self.aliases,
            matcher=self.matcher,
            workspace=self.workspace,
            label=label,
        )

    def match_both(
        self, rows: DataFrame, complaint_names: DataFrame, cutoffs: tuple[int, int]
    ) -> tuple[DataFrame, DataFrame]:
        """Match complaint names and review names. Neither needs the other, so their jobs
        run side by side and share the executors."""
        with ThreadPoolExecutor(2) as pool:
            waiting = [
                pool.submit(inheritable_thread_target(self.spark)(self.match), rows, *work)
                for work in (
                    (self.metric_names[0], complaint_names, cutoffs[0], "complaints"),
                    (RATING_COLUMNS[0], self.reviews_by_name, cutoffs[1], "reviews"),
                )
            ]
            complaint_matches, review_matches = (job.result() for job in waiting)
        return complaint_matches, review_matches

    def fill(
        self, rows: DataFrame, complaint_matches: DataFrame, review_matches: DataFrame
    ) -> DataFrame:
        """Fill what equal keys left empty from the matched names.

        A match belongs to a name, so it may only fill rows that were open when it was
        made: rows of the same name that have figures of their own keep them.
        """
        joined = lookup(
            rows,
            matched_values(
                complaint_matches, self.metrics_by_name, NAME_KEY, self.metric_names, "m_"
            ),
            matched_values(review_matches, self.reviews_by_name, NAME_KEY, RATING_COLUMNS, "m_"),
            key=NAME_KEY,
            right_is_unique=True,
            frequent=self.frequent,
        )
        open_metrics = F.col(self.metric_names[0]).isNull()
        open_ratings = F.col(RATING_COLUMNS[0]).isNull()
        filled = {
            c: F.when(is_open, F.coalesce(F.col(c), F.col("m_" + c))).otherwise(F.col(c))
            for names, is_open in (
                (self.metric_names, open_metrics), (RATING_COLUMNS, open_ratings)
            )
            for c in names
        }
        return joined.withColumns(filled)


def master_table(
    registry: DataFrame,
    reviews: DataFrame,
    complaints: DataFrame,
    *,
    complaint_cutoff: int = COMPLAINT_CUTOFF,
    review_cutoff: int = REVIEW_CUTOFF,
    aliases: Aliases | None = None,
    exclude_used: bool = False,
    dedup_registry_by: str = "id",
    matcher: Matcher | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Full layout: figures by id, else by name, else by the best matching name.

    Complaints are aggregated over all rows of a name. With ``exclude_used`` a complaint
    name that equals some registry name is no candidate for a similar one. ``aliases``
    defaults to the built-in table, ``matcher`` to matching by edit distance; pass
    ``weighted_matcher`` to match by the weighted ratio.
    """
    metrics = aggregate_by_both_keys(complaints, TAX_ID, NAME_KEY, complaint_measures())
    build = _Builder(
        registry, reviews, metrics, FULL_METRICS, workspace, aliases, dedup_registry_by, matcher
    )
    rows = build.exact(metrics_by_name=True)
    candidates = build.metrics_by_name
    if exclude_used:
        candidates = unmatched(candidates, rows.select(NAME_KEY), NAME_KEY)
    matches = build.match_both(rows, candidates, (complaint_cutoff, review_cutoff))
    filled = build.fill(rows, *matches)
    keys = ["segmento", "cnpj", "nome", TAX_ID, NAME_KEY, *FULL_METRICS]
    return select_renamed(filled, {k: k for k in keys} | FULL_RATINGS)


def indicator_table(
    registry: DataFrame,
    reviews: DataFrame,
    complaints: DataFrame,
    *,
    complaint_cutoff: int = COMPLAINT_CUTOFF,
    review_cutoff: int = REVIEW_CUTOFF,
    aliases: Aliases | None = None,
    dedup_registry_by: str = "id",
    matcher: Matcher | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Indicator layout: complaints with an id count by id, the others by matched name."""
    metrics = with_indicator_ratios(
        aggregate_by_either_key(complaints, TAX_ID, NAME_KEY, indicator_measures())
    )
    build = _Builder(
        registry, reviews, metrics, INDICATOR_METRICS, workspace, aliases, dedup_registry_by, matcher
    )
    rows = build.exact(metrics_by_name=False)
    matches = build.match_both(rows, build.metrics_by_name, (complaint_cutoff, review_cutoff))
    filled = build.fill(rows, *matches)
    keys = ["nome", NAME_KEY, TAX_ID, "segmento", *INDICATOR_METRICS]
    return select_renamed(filled, {k: k for k in keys} | INDICATOR_RATINGS)
