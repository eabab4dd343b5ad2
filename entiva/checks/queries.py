"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.checks import standins
from entiva.checks.standins import table
from entiva.functions.aliases import INSTITUTION_ALIASES, resolve_aliases
from entiva.functions.keys import (
    key_present,
    normalize_id,
    normalize_name,
    normalize_name_by_pattern,
)
from entiva.functions.numbers import parse_decimal_comma, ratio, to_double, to_long, whole_to_long
from entiva.operators import quality
from entiva.operators.aggregate import (
    ID,
    NAME,
    aggregate_by_either_key,
    aggregate_by_key,
    branch,
)
from entiva.operators.assign import one_to_one
from entiva.operators.dedup import dedup_by_key_priority, dedup_by_name
from entiva.operators.lookup import (
    backfill,
    first_present,
    lookup,
    matched,
    matched_values,
    one_per_key,
    prefixed,
    unmatched,
)
from entiva.operators.match import (
    best_per_left,
    distinct_names,
    exact_canonical_pairs,
    levenshtein_pairs,
)
from entiva.operators.shape import (
    add_constants,
    drop_all_null,
    fix_types,
    rename_positional,
    rename_present,
    select_present,
    select_renamed,
    union_by_name,
    union_in_order,
)
from entiva.operators.weighted import weighted_best
from entiva.plans import layers
from entiva.plans.delivery import (
    FULL_METRICS,
    NAME_KEY,
    TAX_ID,
    complaint_measures,
    indicator_measures,
    indicator_table,
    master_table,
    with_indicator_ratios,
)
from entiva.plans.trusted import (
    COMPLAINT_COLUMNS,
    RATING_COLUMNS,
    REVIEW_COLUMNS,
    trusted_complaints,
    trusted_registry,
    trusted_reviews,
)
from entiva.session import Workspace
from entiva.sources.readers import read_delimited, read_layer
from entiva.sources.writers import load_layer, load_table, write_layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its own name; a trailing underscore avoids a name clash."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        add_constants(standins.reviews_with_segment(spark, sf_dir), {"origem": "match_v2"}),
        add_constants(standins.reviews_with_id(spark, sf_dir), {"origem": "match_less"}),
    ]
    return union_by_name(frames).select(*REVIEW_COLUMNS, "origem")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_registry(standins.registry(spark, sf_dir))


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_complaints(standins.complaints(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_reviews(raw_reviews(spark, sf_dir))


# Sources and sinks: written to a fresh folder, read back, compared with the given table.


@query
def src_delimited_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).folder("text")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    standins.write_delimited(table(spark, sf_dir, "customer").select(*columns), path, "\t")
    return read_delimited(spark, path, columns, sep="\t")


@query
def src_text_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).folder("text")
    columns = ["event_id", "props", "event_type"]
    events = table(spark, sf_dir, "events").select(*columns)
    standins.write_delimited(events, path, "|", escape="\\")
    return read_delimited(spark, path, columns, sep="|", escape="\\")


@query
def src_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).folder("text")
    columns = ["event_id", "user_id", "value"]
    events = table(spark, sf_dir, "events").select(*columns, F.col("event_type").alias("arquivo"))
    standins.write_delimited(events, path, ";", "ISO-8859-1", by="arquivo")
    standins.add_files_without_data(spark, path)
    united = read_delimited(
        spark,
        path,
        columns,
        sep=";",
        encoding="ISO-8859-1",
        glob="*.csv",
        exclude=layers.NO_DATA,
        recursive=True,
        provenance="origem_arquivo",
        provenance_from=standins.label_of_file(),
    )
    return united.withColumn("value", to_double(F.col("value")))


@query
def src_phantom_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).folder("text")
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    trailing = orders.withColumn("_trailing", F.lit(None).cast("string"))
    standins.write_delimited(trailing, path, ";")
    return read_delimited(spark, path, columns, sep=";", phantom="_trailing")


@query
def src_parquet_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = Workspace(spark).path
    write_layer(complaints(spark, sf_dir), base, layers.TRUSTED, layers.COMPLAINTS)
    stored = read_layer(spark, base, layers.TRUSTED, layers.COMPLAINTS)
    return stored.filter(key_present(F.col(TAX_ID))).select(TAX_ID, NAME_KEY, "indice")


@query
def sink_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = Workspace(spark).path
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    write_layer(customers.limit(1), base, layers.RAW, "customer")
    return spark.read.parquet(write_layer(customers, base, layers.RAW, "customer"))


@query
def sink_typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = Workspace(spark).folder("table"), f"typed_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    frame = orders.groupBy(F.col("o_orderpriority").alias("nome")).agg(
        whole_to_long(F.sum(F.floor("o_totalprice").cast("double")), "total").alias("total"),
        whole_to_long(F.count("o_orderkey").cast("double"), "pedidos").alias("pedidos"),
    )
    load_table(frame, name, path)
    load_table(frame, name, path)
    return spark.table(name)


@query
def sink_load_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace, prefix = Workspace(spark), f"loaded_{uuid.uuid4().hex}_"
    for name in ("customer", "orders", "supplier"):
        write_layer(table(spark, sf_dir, name), workspace.path, layers.DELIVERY, name)
    warehouse = workspace.folder("warehouse")
    load_layer(spark, workspace.path, layers.DELIVERY, warehouse, prefix=prefix)
    tables = load_layer(
        spark, workspace.path, layers.DELIVERY, warehouse, prefix=prefix, mode="append"
    )
    return quality.layer_counts({name: spark.table(loaded) for name, loaded in tables.items()})


@query
def sink_load_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, one of them loaded twice, as a rerun after a failure does."""
    workspace, prefix = Workspace(spark), f"batched_{uuid.uuid4().hex}_"
    warehouse, loaded = workspace.folder("warehouse"), []
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for batch, open_ones in (("day-1", True), ("day-2", False), ("day-1", True)):
        rows = orders.filter((F.col("o_orderstatus") == "O") == open_ones)
        write_layer(rows, workspace.path, layers.DELIVERY, "orders")
        loaded = load_layer(
            spark, workspace.path, layers.DELIVERY, warehouse, prefix=prefix, mode="append",
            batch=batch,
        )
    return spark.table(loaded["orders"])


# Projections.


@query
def proj_select_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_renamed(
        standins.registry(spark, sf_dir), {"Nome": "nome", "CNPJ": "cnpj", "Segmento": "segmento"}
    )
    return rename_present(chosen, {"segmento": "faixa", "not_there": "ignored"})


@query
def proj_positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standins.complaints(spark, sf_dir).withColumn("extra", F.lit("kept"))
    numbered = raw.toDF(*[f"_c{i}" for i in range(len(COMPLAINT_COLUMNS))], "extra")
    renamed = rename_positional(numbered, COMPLAINT_COLUMNS)
    return renamed.select("ano", "trimestre", "instituicao_financeira", "qtd_clientes_scr", "extra")


@query
def proj_drop_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standins.complaints(spark, sf_dir).select(
        "ano", F.lit(None).cast("string").alias("_trailing"), "trimestre", "indice"
    )
    return drop_all_null(raw)


@query
def proj_fix_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"indice": "decimal(11,2)", "qtd_total_reclamacoes": "bigint"}
    fixed = fix_types(complaints(spark, sf_dir), kinds)
    return fixed.select(
        NAME_KEY, F.col("indice").cast("double").alias("indice"), "qtd_total_reclamacoes"
    )


@query
def set_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_reviews(spark, sf_dir).select("nome", "segmento", "cnpj", "geral", "origem")


@query
def set_union_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["nome", "segmento", "cnpj", "origem"]
    return union_in_order(
        [
            add_constants(
                standins.reviews_with_segment(spark, sf_dir), {"cnpj": None, "origem": "match_v2"}
            ),
            add_constants(
                standins.reviews_with_id(spark, sf_dir), {"segmento": None, "origem": "match_less"}
            ),
        ],
        order,
    )


# Scalar functions.


@query
def scalar_normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = normalize_name(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(name).alias("digest"), F.length(name).alias("n_chars_kept")
    )


@query
def scalar_normalize_name_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = normalize_name_by_pattern(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(name).alias("digest"), F.length(name).alias("n_chars_kept")
    )


@query
def scalar_normalize_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", normalize_id(F.col("url")).alias("id_of_url")
    )


@query
def scalar_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standins.complaints(spark, sf_dir)
    return raw.select(
        "instituicao_financeira", parse_decimal_comma(F.col("indice")).alias("indice")
    )


@query
def scalar_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("string")
    text = F.when(F.col("l_linenumber") == 3, F.concat(quantity, F.lit("x"))).otherwise(quantity)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        to_double(text).alias("as_double"),
        to_long(text).alias("as_long"),
    )


@query
def scalar_alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    shorts = F.array(*[F.lit(s) for s in INSTITUTION_ALIASES])
    key = F.col("p_partkey")
    name = F.when(
        key % 3 == 0, F.element_at(shorts, (key % len(INSTITUTION_ALIASES) + 1).cast("int"))
    ).otherwise(normalize_name(F.col("p_name")))
    parts = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return resolve_aliases(parts, "name", "canonical")


# Filters, deduplication, aggregation.


@query
def filter_key_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = complaints(spark, sf_dir).filter(key_present(F.col(TAX_ID)))
    return rows.select(TAX_ID, NAME_KEY, "indice", "qtd_total_reclamacoes")


@query
def dedup_by_name_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_name(registry(spark, sf_dir))


@query
def dedup_by_key_priority_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key_priority(registry(spark, sf_dir))


@query
def agg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_by_key(complaints(spark, sf_dir), NAME_KEY, complaint_measures(), "n_")


@query
def agg_count_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {"n_rows": F.count(F.lit(1)), "n_values": F.count("qtd_total_reclamacoes")}
    return aggregate_by_key(complaints(spark, sf_dir), TAX_ID, measures)


@query
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "n_quarter_numbers": F.countDistinct("trimestre"),
        "n_quarters": F.countDistinct("ano", "trimestre"),
    }
    return aggregate_by_key(complaints(spark, sf_dir), NAME_KEY, measures)


@query
def agg_two_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_by_either_key(
        complaints(spark, sf_dir), TAX_ID, NAME_KEY, indicator_measures()
    )


@query
def agg_ratio_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = aggregate_by_key(
        complaints(spark, sf_dir),
        NAME_KEY,
        {
            "total": F.sum("qtd_total_reclamacoes"),
            "customers": F.sum("qtd_total_clientes_ccs_e_scr"),
            "upheld": F.sum("qtd_reclamacoes_reguladas_procedentes"),
        },
    )
    return totals.select(
        NAME_KEY,
        ratio(F.col("total"), F.col("customers")).alias("per_customer"),
        ratio(F.col("upheld"), F.col("total")).alias("share_upheld"),
    )


# Joins.


def figures(spark: SparkSession, sf_dir: str, key: str, prefix: str = "") -> DataFrame:
    return aggregate_by_key(complaints(spark, sf_dir), key, complaint_measures(), prefix)


@query
def join_left_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup(
        registry(spark, sf_dir), figures(spark, sf_dir, TAX_ID), key=TAX_ID, right_is_unique=True
    )
    return rows.select("nome", TAX_ID, *FULL_METRICS)


@query
def join_left_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookup(
        registry(spark, sf_dir),
        figures(spark, sf_dir, NAME_KEY),
        key=NAME_KEY,
        right_is_unique=True,
    )
    return rows.select("nome", NAME_KEY, *FULL_METRICS)


@query
def join_lookup_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = reviews(spark, sf_dir).select(NAME_KEY, TAX_ID, *RATING_COLUMNS[:3])
    found = prefixed(ratings, "r_", [TAX_ID])
    rows = lookup(
        registry(spark, sf_dir), found, key=NAME_KEY, order=[~key_present(F.col("r_" + TAX_ID))]
    )
    return rows.select("nome", NAME_KEY, "r_" + TAX_ID, *RATING_COLUMNS[:3])


@query
def join_empty_key_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = complaints(spark, sf_dir).groupBy(TAX_ID).agg(
        F.sum("qtd_total_reclamacoes").alias("total")
    )
    rows = lookup(registry(spark, sf_dir), totals, key=TAX_ID, right_is_unique=True)
    return rows.select("nome", TAX_ID, "total")


@query
def join_key_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_id = lookup(
        dedup_by_key_priority(registry(spark, sf_dir)),
        figures(spark, sf_dir, TAX_ID, "c_"),
        key=TAX_ID,
        right_is_unique=True,
    )
    rows = lookup(
        by_id, figures(spark, sf_dir, NAME_KEY, "n_"), key=NAME_KEY, right_is_unique=True
    )
    return first_present(rows, {m: ["c_" + m, "n_" + m] for m in FULL_METRICS})


@query
def join_semi_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = complaints(spark, sf_dir).select(NAME_KEY).distinct()
    known = registry(spark, sf_dir)
    return quality.layer_counts(
        {"matched": matched(names, known, NAME_KEY), "unmatched": unmatched(names, known, NAME_KEY)}
    )


@query
def join_anti_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = complaints(spark, sf_dir).select(NAME_KEY).distinct()
    return unmatched(names, registry(spark, sf_dir), NAME_KEY)


# Matching.


def part_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Distinct brand-and-name texts, once as they are and once with letters changed."""
    text = normalize_name(F.concat_ws(" ", "p_brand", "p_name"))
    names = table(spark, sf_dir, "part").select(text.alias("name")).distinct()
    edited = F.regexp_replace(F.regexp_replace("name", "OL", "LO"), "RED", "REDD")
    return distinct_names(names.select(edited.alias("name")), "name", {}), distinct_names(
        names, "name", {}
    )


@query
def match_exact_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_canonical_pairs(
        distinct_names(registry(spark, sf_dir), NAME_KEY),
        distinct_names(complaints(spark, sf_dir), NAME_KEY),
    )


@query
def match_fuzzy_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = part_names(spark, sf_dir)
    workspace = Workspace(spark)
    return best_per_left(
        levenshtein_pairs(
            workspace.keep(left, "left"), workspace.keep(right, "right"), 80, workspace, "parts"
        )
    )


@query
def match_fuzzy_wratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = part_names(spark, sf_dir)
    workspace = Workspace(spark)
    return weighted_best(
        workspace.keep(left, "left"), workspace.keep(right, "right"), 80, workspace, "parts"
    )


@query
def match_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(normalize_name(F.col("c_name")).alias("name"))
    left = distinct_names(names.select(F.regexp_replace("name", ".$", "").alias("name")), "name")
    workspace = Workspace(spark)
    pairs = levenshtein_pairs(
        workspace.keep(left, "left"),
        workspace.keep(distinct_names(names, "name"), "right"),
        94,
        workspace,
        "customers",
    )
    return one_to_one(pairs, workspace, "customers")


@query
def match_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    by_name = workspace.keep(figures(spark, sf_dir, NAME_KEY), "figures")
    rows = workspace.keep(
        lookup(
            dedup_by_key_priority(registry(spark, sf_dir)),
            by_name,
            key=NAME_KEY,
            right_is_unique=True,
        ),
        "rows",
    )
    open_names = distinct_names(rows.filter(F.col(FULL_METRICS[0]).isNull()), NAME_KEY, {})
    pairs = levenshtein_pairs(
        workspace.keep(open_names, "left"),
        workspace.keep(distinct_names(by_name, NAME_KEY, {}), "right"),
        80,
        workspace,
        "names",
    )
    best = best_per_left(pairs).select(
        F.col("left").alias(NAME_KEY), F.col("right").alias("candidate")
    )
    values = matched_values(best, by_name, NAME_KEY, FULL_METRICS, "m_")
    return backfill(rows, values, name=NAME_KEY, columns=FULL_METRICS, prefix="m_").select(
        "nome", NAME_KEY, *FULL_METRICS
    )


# Jobs and reports.


@query
def job_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    files = standins.write_source_files(spark, sf_dir, workspace)
    layers.run_raw(spark, files, workspace.path)
    return read_layer(spark, workspace.path, layers.RAW, layers.COMPLAINTS)


@query
def job_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    files = standins.write_source_files(spark, sf_dir, workspace)
    layers.run_raw(spark, files, workspace.path)
    names = (layers.REGISTRY, layers.REVIEWS, layers.COMPLAINTS)
    return quality.layer_counts(
        {name: read_layer(spark, workspace.path, layers.RAW, name) for name in names}
    )


@query
def job_trusted_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry(spark, sf_dir)


@query
def job_trusted_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).select(
        "employer_name", "nome", "cnpj", "segmento", "origem", *RATING_COLUMNS, NAME_KEY, TAX_ID
    )


@query
def job_trusted_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complaints(spark, sf_dir)


@query
def delivery_master_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_table(
        registry(spark, sf_dir), reviews(spark, sf_dir), complaints(spark, sf_dir)
    )


@query
def delivery_contested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several names want one: the best pair wins it, and the loser its next best."""
    return master_table(
        trusted_registry(standins.contested_registry(spark, sf_dir)),
        reviews(spark, sf_dir),
        trusted_complaints(standins.complaints(spark, sf_dir, contested=True)),
    )


@query
def delivery_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicator_table(
        registry(spark, sf_dir), reviews(spark, sf_dir), complaints(spark, sf_dir)
    )


@query
def job_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    files = standins.write_source_files(spark, sf_dir, workspace)
    layers.run_all(spark, files, workspace.path, layouts=[layers.MASTER])
    return read_layer(spark, workspace.path, layers.DELIVERY, layers.MASTER)


@query
def job_full_run_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    files = standins.write_source_files(spark, sf_dir, workspace)
    layers.run_all(spark, files, workspace.path, layouts=[layers.INDICATORS])
    return read_layer(spark, workspace.path, layers.DELIVERY, layers.INDICATORS)


@query
def report_cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    files = standins.write_source_files(spark, sf_dir, workspace)
    layers.run_raw(spark, files, workspace.path)
    layers.run_trusted(spark, workspace.path)
    return layers.loss_report(spark, workspace.path)


@query
def report_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = registry(spark, sf_dir)
    return quality.layer_counts(
        {
            "registry": known,
            "reviews": reviews(spark, sf_dir),
            "complaints": complaints(spark, sf_dir),
            "delivery": dedup_by_key_priority(known),
        }
    )


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows with complaint figures and ratings found by equal keys."""
    ratings = one_per_key(
        reviews(spark, sf_dir), NAME_KEY, order=[~key_present(F.col(TAX_ID))]
    ).select(NAME_KEY, F.col("geral").alias("nota_geral"))
    return lookup(
        join_key_precedence(spark, sf_dir), ratings, key=NAME_KEY, right_is_unique=True
    )


@query
def report_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(rated(spark, sf_dir), "qtd_total_reclamacoes", "nota_geral")


@query
def report_key_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_completeness(complaints(spark, sf_dir), TAX_ID)


@query
def report_replacement_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn(
        "text", F.replace(F.col("text"), F.lit("é"), F.lit(quality.REPLACEMENT))
    )
    return quality.replacement_chars(documents, ["text", "lang", "source"])


@query
def report_match_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digits(name: str):
        return F.regexp_replace(F.col(name), "[^0-9]", "")

    rules = {
        "digits": (digits("CNPJ"), digits("cnpj_if")),
        "without_zeros": (normalize_id(F.col("CNPJ")), normalize_id(F.col("cnpj_if"))),
    }
    return quality.match_uplift(
        standins.registry(spark, sf_dir), standins.complaints(spark, sf_dir), rules
    )


@query
def report_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = F.round(F.col("indice_medio").cast("decimal(20,6)"), 1).cast("double")
    return quality.ranked(
        rated(spark, sf_dir),
        required=["nota_geral", "qtd_total_reclamacoes"],
        by="qtd_total_reclamacoes",
        then=NAME_KEY,
        columns=[
            NAME_KEY, "segmento", "qtd_total_reclamacoes", rounded.alias("indice"), "nota_geral"
        ],
    )


@query
def proj_select_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggregated = with_indicator_ratios(agg_two_branch(spark, sf_dir))
    wanted = ["key", "reclamacao_total", "not_there", "reclamacao_pct_procedentes"]
    by_name = branch(aggregated, NAME, "key")
    return select_present(by_name.unionByName(branch(aggregated, ID, "key")), wanted)
