"""Raw, trusted and delivery layers, loaded in order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.operators.shape import add_constants, require_widths, union_by_name
from entiva.plans.delivery import indicator_table, master_table
from entiva.plans.ledger import Ledger, files_fingerprint
from entiva.plans.trusted import (
    COMPLAINT_COLUMNS,
    COMPLAINT_COUNTS,
    KEY_WIDTHS,
    RATING_COLUMNS,
    REGISTRY_SOURCE,
    REVIEW_COLUMNS,
    trusted_complaints,
    trusted_registry,
    trusted_reviews,
)
from entiva.sources.readers import read_delimited, read_layer
from entiva.session import Workspace
from entiva.sources.writers import load_layer, publish_layer, write_layer

# Names of the layers, of their datasets, and of files without data.
RAW, TRUSTED, DELIVERY = "raw", "trusted", "delivery"
REGISTRY, REVIEWS, COMPLAINTS = "bancos", "empregados", "reclamacoes"
MASTER, INDICATORS = "banco_final", "bancos_indicadores"
NO_DATA = "nao_ha_dados"

_REVIEW_COMMON = [c for c in REVIEW_COLUMNS if c not in ("segmento", "cnpj")]
_TAIL = _REVIEW_COMMON.index("nome")
REVIEWS_WITH_SEGMENT = [*_REVIEW_COMMON[:_TAIL], "segmento", *_REVIEW_COMMON[_TAIL:]]
REVIEWS_WITH_ID = [*_REVIEW_COMMON[:_TAIL], "cnpj", *_REVIEW_COMMON[_TAIL:]]


@dataclass(frozen=True)
class SourceFiles:
    """Where the three sources lie. The two review files differ in their 21st column."""

    registry: str
    reviews_with_segment: str
    reviews_with_id: str
    complaints: str
    glob: str = "*.csv"
    recursive: bool = False
    provenance_from: Column | None = None


def raw_registry(spark: SparkSession, files: SourceFiles) -> DataFrame:
    return read_delimited(spark, files.registry, REGISTRY_SOURCE, sep="\t")


def raw_reviews(spark: SparkSession, files: SourceFiles) -> DataFrame:
    """Both review files as one table of 24 columns and ``origem``."""
    with_segment = read_delimited(spark, files.reviews_with_segment, REVIEWS_WITH_SEGMENT, sep="|")
    with_id = read_delimited(spark, files.reviews_with_id, REVIEWS_WITH_ID, sep="|")
    united = union_by_name(
        [
            add_constants(with_segment, {"origem": "match_v2"}),
            add_constants(with_id, {"origem": "match_less"}),
        ]
    )
    return united.select(*REVIEW_COLUMNS, "origem")


def raw_complaints(spark: SparkSession, files: SourceFiles) -> DataFrame:
    """All quarterly files as one table, with the file each row came from."""
    return read_delimited(
        spark,
        files.complaints,
        COMPLAINT_COLUMNS,
        sep=";",
        encoding="ISO-8859-1",
        phantom="_trailing",
        glob=files.glob,
        exclude=NO_DATA,
        recursive=files.recursive,
        provenance="origem_arquivo",
        provenance_from=files.provenance_from,
    )


def run_raw(spark: SparkSession, files: SourceFiles, base: str) -> None:
    write_layer(raw_registry(spark, files), base, RAW, REGISTRY)
    write_layer(raw_reviews(spark, files), base, RAW, REVIEWS)
    write_layer(raw_complaints(spark, files), base, RAW, COMPLAINTS)


def run_trusted(spark: SparkSession, base: str, rule: str = "literal") -> None:
    cleaners = {
        REGISTRY: trusted_registry, REVIEWS: trusted_reviews, COMPLAINTS: trusted_complaints
    }
    for name, clean in cleaners.items():
        cleaned = clean(read_layer(spark, base, RAW, name), rule)
        # checked in the write, so that a key that is too long publishes nothing
        publish_layer(require_widths(cleaned, KEY_WIDTHS), base, TRUSTED, name)


def loss_report(spark: SparkSession, base: str) -> DataFrame:
    """``dataset, field, lost``: values of the raw layer that the trusted one could not parse."""
    reports = []
    for name, kinds in ((REVIEWS, RATING_COLUMNS), (COMPLAINTS, ["indice", *COMPLAINT_COUNTS])):
        # a blank is no value, so nothing is lost with it
        raw = read_layer(spark, base, RAW, name).agg(
            *[F.count_if(F.trim(k) != "").alias(k) for k in kinds]
        )
        kept = read_layer(spark, base, TRUSTED, name).agg(*[F.count(k).alias(k) for k in kinds])
        before, after = (
            df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("n"))
                                          for k in kinds])).alias("x")).select("x.field", "x.n")
            for df in (raw, kept)
        )
        reports.append(
            before.join(after.withColumnRenamed("n", "kept"), "field").select(
                F.lit(name).alias("dataset"), "field", (F.col("n") - F.col("kept")).alias("lost")
            )
        )
    return reports[0].unionByName(reports[1])


def run_delivery(
    spark: SparkSession,
    base: str,
    layouts: Sequence[str] = (MASTER, INDICATORS),
    *,
    warehouse: str | None = None,
    table_prefix: str = "",
    **options: Any,
) -> None:
    """Build the layouts from the trusted layer; ``options`` (cutoffs, aliases, matcher, rule of
    deduplication) go to both. With ``warehouse`` the layer is then loaded into tables there.
    Intermediate tables are deleted once the layouts are stored.
    """
    builders = {MASTER: master_table, INDICATORS: indicator_table}
    registry, reviews, complaints = (
        read_layer(spark, base, TRUSTED, name) for name in (REGISTRY, REVIEWS, COMPLAINTS)
    )
    for layout in layouts:
        with Workspace(spark) as workspace:
            table = builders[layout](
                registry, reviews, complaints, workspace=workspace, **options
            )
            publish_layer(table, base, DELIVERY, layout)
    if warehouse is not None:
        load_layer(spark, base, DELIVERY, warehouse, prefix=table_prefix)


def sources_fingerprint(spark: SparkSession, files: SourceFiles) -> list[str]:
    """What the raw layer is made from: the files, and how they are read."""
    plain = files_fingerprint(
        spark, [files.registry, files.reviews_with_segment, files.reviews_with_id]
    )
    quarterly = files_fingerprint(spark, [files.complaints], files.glob, files.recursive)
    return [plain, quarterly, str(files)]


def run_all(
    spark: SparkSession,
    files: SourceFiles,
    base: str,
    *,
    rule: str = "literal",
    layouts: Sequence[str] = (MASTER, INDICATORS),
    warehouse: str | None = None,
    table_prefix: str = "",
    resume: bool = False,
    **options: Any,
) -> None:
    """Run the layers in order; ``options`` are those of :func:`run_delivery`. An error stops
    the run, so no layer is built on a broken one.

    With ``resume`` a step is left out if the run that stored it had the same source files
    (path, length, time of change), rule and options, so a run that was stopped goes on from
    the last layer that it published. Changed code is not noticed; run without ``resume`` then.
    Options given as frames, lambdas or objects count as changed. The load into tables, which
    is done last, is always repeated.
    """
    ledger = Ledger(spark, base, resume)
    made = ledger.run(
        RAW, sources_fingerprint(spark, files), lambda: run_raw(spark, files, base)
    )
    made = ledger.run(TRUSTED, [made, rule], lambda: run_trusted(spark, base, rule))
    for layout in layouts:
        ledger.run(
            f"{DELIVERY}-{layout}",
            [made, layout, options],
            lambda layout=layout: run_delivery(spark, base, [layout], **options),
        )
    if warehouse is not None:
        load_layer(spark, base, DELIVERY, warehouse, prefix=table_prefix)
