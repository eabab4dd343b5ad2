import pytest
from pyspark.sql import functions as F

from entiva.operators.dedup import dedup_by_key_priority
from entiva.operators.weighted import weighted_matcher
from entiva.plans import layers
from entiva.plans.delivery import FULL_METRICS, indicator_table, master_table
from entiva.plans.trusted import (
    COMPLAINT_COLUMNS,
    RATING_COLUMNS,
    REVIEW_COLUMNS,
    trusted_complaints,
    trusted_registry,
    trusted_reviews,
)
from entiva.sources.readers import read_layer


def registry(spark, data):
    return trusted_registry(spark.createDataFrame(data, "Segmento string, CNPJ string, Nome string"))


def complaints(spark, data):
    full = [
        {"ano": "2021", "trimestre": quarter, "cnpj_if": tax_id, "instituicao_financeira": name,
         "indice": index, "qtd_reclamacoes_reguladas_procedentes": upheld,
         "qtd_total_reclamacoes": total, "qtd_total_clientes_ccs_e_scr": customers}
        for tax_id, name, quarter, index, upheld, total, customers in data
    ]
    rows = [tuple(row.get(c, "0") for c in COMPLAINT_COLUMNS) for row in full]
    return trusted_complaints(
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COMPLAINT_COLUMNS))
    )


def reviews(spark, data):
    rows = []
    for tax_id, name, rating in data:
        row = dict.fromkeys(REVIEW_COLUMNS, "x") | dict.fromkeys(RATING_COLUMNS, rating)
        rows.append(tuple((row | {"cnpj": tax_id, "nome": name})[c] for c in REVIEW_COLUMNS))
    return trusted_reviews(
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in REVIEW_COLUMNS))
    )


@pytest.fixture
def sources(spark):
    return (
        registry(spark, [
            ("S1", "0", "BANCO DO BRASIL - PRUDENCIAL"),
            ("S1", "0", "BANCO DO BRASIL S/A"),
            ("S1", "360305", "CAIXA ECONOMICA FEDERAL"),
            ("S2", "11", "BANCO FIBRA S.A."),
            ("S2", "12", "BANCO FIBRA S.A."),
            ("S3", "13", "COOPERATIVA DO NORTE"),
            ("S4", "14", "SEM DADOS"),
        ]),
        reviews(spark, [
            (None, "CAIXA ECONÔMICA FEDERAL", "4.4"),
            ("360305", "CAIXA ECONÔMICA FEDERAL", "4.5"),
            (None, "BANCO FIBRA", "3.0"),
            (None, "COOPERATIVA DO NORTES", "2.0"),
        ]),
        complaints(spark, [
            ("00360305", "CAIXA ECONÔMICA FEDERAL (conglomerado)", "1", "15,52", "1", "10", "100"),
            ("00360305", "CAIXA ECONÔMICA FEDERAL (conglomerado)", "2", "14.015,05", "2", "30", "0"),
            (" ", "BB (conglomerado)", "1", " ", "5", "50", "0"),
            (" ", "BANCO FIBRA", "1", "1,00", "0", "0", "10"),
            (" ", "COOPERATIVA D NORTE", "1", "2,00", "1", "4", "8"),
            (" ", "", "1", "9,00", "1", "999", "1"),
        ]),
    )


@pytest.mark.parametrize("parts", [1, 37])
def test_full_layout(spark, sources, parts):
    known, rated, filed = (df.repartition(parts) for df in sources)
    got = {(r["cnpj"], r["nome_norm"]): r for r in master_table(known, rated, filed).collect()}
    assert len(got) == 6
    bank = got["0", "BANCO DO BRASIL"]
    assert [bank[m] for m in FULL_METRICS] == [50, 5, None, 1]
    federal = got["360305", "CAIXA ECONOMICA FEDERAL"]
    assert [federal[m] for m in FULL_METRICS] == [40, 3, (15.52 + 14015.05) / 2, 2]
    assert federal["nota_geral"] == 4.5 and federal["pct_perspectiva"] == 4.5
    # Two banks of one name both get its figures, and no row is multiplied.
    assert [got[i, "BANCO FIBRA"]["qtd_total_reclamacoes"] for i in ("11", "12")] == [0, 0]
    assert got["13", "COOPERATIVA DO NORTE"]["qtd_total_reclamacoes"] == 4
    assert got["13", "COOPERATIVA DO NORTE"]["nota_geral"] == 2.0
    assert got["14", "SEM DADOS"]["qtd_total_reclamacoes"] is None


def test_options_of_the_full_layout(spark, sources):
    by_name = master_table(*sources, dedup_registry_by="name").collect()
    assert len(by_name) == 5
    strict = master_table(*sources, complaint_cutoff=100, review_cutoff=100, aliases={}).collect()
    assert {r["nome_norm"] for r in strict if r["qtd_total_reclamacoes"] is not None} == {
        "CAIXA ECONOMICA FEDERAL", "BANCO FIBRA"
    }
    weighted = master_table(*sources, matcher=weighted_matcher, exclude_used=True).collect()
    figures = {r["nome_norm"]: r["qtd_total_reclamacoes"] for r in weighted}
    assert figures["COOPERATIVA DO NORTE"] == 4 and figures["BANCO DO BRASIL"] == 50


def test_indicator_layout(spark, sources):
    got = {r["nome"]: r for r in indicator_table(*sources).collect()}
    federal = got["CAIXA ECONOMICA FEDERAL"]
    assert federal["reclamacao_total"] == 40 and federal["reclamacao_trimestres"] == 2
    assert federal["reclamacao_indice_calculado"] == 0.4
    assert federal["reclamacao_pct_procedentes"] == 3 / 40
    fibra = got["BANCO FIBRA S.A."]
    assert fibra["reclamacao_pct_procedentes"] is None and fibra["avaliacao_geral"] == 3.0
    assert got["COOPERATIVA DO NORTE"]["reclamacao_total"] == 4


def test_a_matched_name_does_not_overwrite_rows_that_have_figures(spark):
    known = registry(spark, [("S1", "1", "BANCO AZUL DO SUL"), ("S1", "2", "BANCO AZUL DO SUL")])
    filed = complaints(spark, [
        ("1", "OUTRO NOME", "1", " ", "1", "7", "1"),
        (" ", "BANCO AZUL DO SULX", "1", "3,00", "1", "9", "1"),
    ])
    rated = reviews(spark, [(None, "NINGUEM", "1.0")])
    got = {r["cnpj"]: r for r in master_table(known, rated, filed).collect()}
    assert (got["1"]["qtd_total_reclamacoes"], got["1"]["indice_medio"]) == (7, None)
    assert (got["2"]["qtd_total_reclamacoes"], got["2"]["indice_medio"]) == (9, 3.0)


def test_reviews_keep_text_ids_and_missing_names(spark):
    df = reviews(spark, [("00655522", "APEX", "3.2"), (None, None, " ")])
    got = [(r["cnpj_norm"], r["nome_norm"], r["geral"]) for r in df.orderBy("nome").collect()]
    assert got == [("", "", None), ("655522", "APEX", 3.2)]
    assert dedup_by_key_priority(df).count() == 2


def write_sources(folder):
    (folder / "complaints").mkdir()
    (folder / "registry.tsv").write_text(
        "Segmento\tCNPJ\tNome\nS1\t360305\tCAIXA ECONOMICA FEDERAL\nS2\t0\tBANCO FIBRA S.A.\n"
    )
    common = [c for c in REVIEW_COLUMNS if c not in ("segmento", "cnpj")]
    values = {c: "1.5" if c in RATING_COLUMNS else c for c in common}
    for name, columns, extra in (
        ("segment.csv", layers.REVIEWS_WITH_SEGMENT, {"segmento": "S2", "nome": "BANCO FIBRA"}),
        ("id.csv", layers.REVIEWS_WITH_ID, {"cnpj": "00360305", "nome": "CAIXA"}),
    ):
        row = values | extra
        (folder / name).write_text(
            "|".join(columns) + "\n" + "|".join(row[c] for c in columns) + "\n"
        )
    header = ";".join(f"coluna \x96 {i}" for i in range(14)) + ";\n"
    line = "2021;1º;c;t; ;BANCO FIBRA (conglomerado);1.015,50;1;0;0;2;10;10;0;\n"
    (folder / "complaints" / "2021_tri_01.csv").write_bytes((header + line).encode("latin-1"))
    (folder / "complaints" / "2021_tri_02_nao_ha_dados.csv").write_bytes(b"")
    return layers.SourceFiles(
        registry=str(folder / "registry.tsv"),
        reviews_with_segment=str(folder / "segment.csv"),
        reviews_with_id=str(folder / "id.csv"),
        complaints=str(folder / "complaints"),
    )


def test_full_run(spark, workspace, tmp_path):
    files = write_sources(tmp_path)
    layers.run_all(spark, files, workspace.path)
    raw = read_layer(spark, workspace.path, "raw", "reclamacoes").first()
    assert raw["origem_arquivo"] == "2021_tri_01.csv" and raw["trimestre"] == "1º"
    origins = read_layer(spark, workspace.path, "raw", "empregados").select("origem", "segmento", "cnpj")
    assert sorted(map(tuple, origins.collect())) == [
        ("match_less", None, "00360305"), ("match_v2", "S2", None)
    ]
    master = {r["nome"]: r for r in read_layer(spark, workspace.path, "delivery", "banco_final").collect()}
    assert len(master["BANCO FIBRA S.A."].asDict()) == 18
    assert master["BANCO FIBRA S.A."]["indice_medio"] == 1015.5
    assert master["BANCO FIBRA S.A."]["nota_geral"] == 1.5
    assert master["CAIXA ECONOMICA FEDERAL"]["nota_geral"] == 1.5
    losses = layers.loss_report(spark, workspace.path)
    assert losses.count() == 17 and losses.filter("lost <> 0").isEmpty()
    layers.run_delivery(
        spark, workspace.path, [layers.MASTER], warehouse=workspace.folder("wh"),
        table_prefix="t_run_", complaint_cutoff=90, review_cutoff=95,
    )
    assert spark.table("t_run_banco_final").count() == 2
    layout = read_layer(spark, workspace.path, "delivery", "bancos_indicadores")
    assert len(layout.columns) == 18 and layout.count() == 2


def test_a_failing_layer_stops_the_run(spark, workspace, tmp_path):
    files = write_sources(tmp_path)
    (tmp_path / "registry.tsv").write_text(f"Segmento\tCNPJ\tNome\nS1\t1\t{'A' * 256}\n")
    with pytest.raises(Exception, match="exceeds 255"):
        layers.run_all(spark, files, workspace.path)
    with pytest.raises(Exception):
        read_layer(spark, workspace.path, "delivery", "banco_final")


def test_a_stopped_run_goes_on_from_the_last_layer(spark, workspace, tmp_path, monkeypatch):
    files, base = write_sources(tmp_path), workspace.path
    ran = []
    for name in ("run_raw", "run_trusted", "run_delivery"):
        real = getattr(layers, name)

        def noted(*args, real=real, name=name, **options):
            ran.append(name)
            return real(*args, **options)

        monkeypatch.setattr(layers, name, noted)
    master = layers.master_table

    def broken(*_, **__):
        raise RuntimeError("stopped")

    run = lambda **options: layers.run_all(
        spark, files, base, layouts=[layers.MASTER], resume=True, **options
    )
    monkeypatch.setattr(layers, "master_table", broken)
    with pytest.raises(RuntimeError):
        run()
    assert ran == ["run_raw", "run_trusted", "run_delivery"]
    monkeypatch.setattr(layers, "master_table", master)
    ran.clear()
    run()  # raw files are not read again, delivery is
    assert ran == ["run_delivery"]
    whole = read_layer(spark, base, "delivery", "banco_final").collect()
    assert len(whole) == 2
    ran.clear()
    run()
    assert ran == []
    run(complaint_cutoff=95)  # other options
    assert ran == ["run_delivery"]
    ran.clear()
    run(complaint_cutoff=95, aliases=spark.createDataFrame([("A", "B")], "nome string, canonico string"))
    assert ran == ["run_delivery"]  # a frame has no fingerprint
    ran.clear()
    with (tmp_path / "registry.tsv").open("a") as out:
        out.write("S4\t77\tBANCO NOVO\n")
    run()
    assert ran == ["run_raw", "run_trusted", "run_delivery"]
    assert read_layer(spark, base, "delivery", "banco_final").count() == 3
    ran.clear()
    layers.run_all(spark, files, base, layouts=[layers.MASTER])
    assert ran == ["run_raw", "run_trusted", "run_delivery"]


def test_rules_differ_on_the_short_suffix(spark):
    raw = spark.createDataFrame([("S1", "1", "BANCO DAYCOVAL S.A")], "a string, b string, c string")
    names = [trusted_registry(raw, rule).first()["nome_norm"] for rule in ("literal", "pattern")]
    assert names == ["BANCO DAYCOVAL SA", "BANCO DAYCOVAL"]
    assert trusted_registry(raw).select(F.col("segmento")).first()[0] == "S1"


# Id (if any) and name of the 39 published review rows.
REVIEWED = """
655522|APE POUPEX
58160789|SAFRA
7450604|CHINA CONSTRUCTION BANK (BRASIL) BANCO MULTIPLO S/
60814191|MERCEDES-BENZ
60518222|BANCO SUMITOMO MITSUI BRASIL S.A.
|BNP PARIBAS
|BTG PACTUAL
|ALFA
|BMG
|BRADESCO
|BANCO DAYCOVAL S.A
|BANCO FIBRA S.A.
|ORIGINAL
|PAN
|PINE
|VOTORANTIM
|BANCO DO BRASIL
|BANCO DO NORDESTE DO BRASIL S.A.
|BANCO TOKYO-MITSUBISHI BM S.A.
|BANRISUL
|CAIXA ECONOMICA FEDERAL
|CITIBANK
|CREDIT SUISSE
|DEUTSCHE
|GOLDMAN SACHS
|ING
|ITAU
|JP MORGAN CHASE
|BOFA MERRILL LYNCH
|MORGAN STANLEY
|SANTANDER
|SICREDI
|SOCIETE GENERALE
|VOTORANTIM
|APE POUPEX
|CHINA CONSTRUCTION BANK (BRASIL) BANCO MULTIPLO S/
|JP MORGAN CHASE
|MERCEDES-BENZ
|BANCO SUMITOMO MITSUI BRASIL S.A.
"""


def test_published_reviews_reduce_to_one_row_per_name(spark):
    rows = [tuple(line.split("|")) for line in REVIEWED.split("\n") if line]
    df = reviews(spark, [(tax_id or None, name, "3.0") for tax_id, name in rows])
    kept = dedup_by_key_priority(df)
    assert (len(rows), kept.count(), kept.select("nome_norm").distinct().count()) == (39, 37, 33)


def test_contested_names_tell_one_to_one_from_best_per_name():
    """The statement of the contested query, and the same with each name's best candidate."""
    import duckdb

    from entiva.checks import oracle

    database = duckdb.connect()
    for name in ("customer", "orders", "supplier"):
        database.execute(f"create view {name} as from '/root/testdata/sf0.01/{name}.parquet'")
    sources = (
        f"{oracle._LISTED}, {oracle._CONTESTED}, {oracle.TRUSTED_REGISTRY}, "
        f"{oracle._raw_complaints(oracle._CUT_FURTHER)}, {oracle.TRUSTED_COMPLAINTS}"
    )
    top_one = oracle._master(
        oracle.METRICS, oracle.FULL_RATINGS, f"{oracle.BY_ID}, {oracle.BY_NAME}", True,
        ["segmento", "cnpj", "nome", "cnpj_norm", "nome_norm"], sources,
    )
    other = database.execute(
        f"select count(*) from (({oracle.MASTER_CONTESTED}) except ({top_one}))"
    ).fetchone()[0]
    assert other >= 50
    ratings = ("nota_geral", "geral")
    columns = database.execute(f"describe {oracle.MASTER_CONTESTED}").df()["column_name"].tolist()
    rating = next(c for c in columns if any(r in c for r in ratings))
    rated = {
        sql: database.execute(f"select count({rating}) from ({sql})").fetchone()[0]
        for sql in (oracle.MASTER_CONTESTED, top_one)
    }
    assert rated[oracle.MASTER_CONTESTED] < rated[top_one]  # a rival gets no rating twice
