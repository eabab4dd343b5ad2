import os

import pytest
from pyspark.sql import functions as F

from entiva.session import Workspace, scratch_root
from entiva.sources import writers
from entiva.sources.readers import (
    JdbcSplit,
    jdbc_read_options,
    list_layer,
    read_delimited,
    read_jdbc,
    read_layer,
)
from entiva.sources.writers import (
    jdbc_column_types,
    jdbc_write_options,
    load_batch,
    load_layer,
    load_table,
    publish_layer,
    write_layer,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_quarterly_files(spark, tmp_path):
    (tmp_path / "2021_tri_01.csv").write_bytes("Ano;Instituição;\n2021;CAIXA ECONÔMICA;\n".encode("latin-1"))
    (tmp_path / "2021_tri_02.csv").write_bytes("Ano;Institui\x96;\r\n\r\n2021;B \"x\";\r\n".encode("latin-1"))
    (tmp_path / "2022_tri_01.csv").write_bytes(b"")
    (tmp_path / "2022_tri_02_nao_ha_dados.csv").write_bytes(b"Ano;x;\n1;2;\n")
    (tmp_path / "notes.txt").write_bytes(b"Ano;x;\n3;4;\n")
    df = read_delimited(
        spark, str(tmp_path), ["ano", "nome"], sep=";", encoding="ISO-8859-1", phantom="_t",
        glob="*.csv", exclude="nao_ha_dados", provenance="origem_arquivo",
    )
    assert rows(df) == [
        ("2021", 'B "x"', "2021_tri_02.csv"), ("2021", "CAIXA ECONÔMICA", "2021_tri_01.csv")
    ]


@pytest.mark.parametrize(
    "escape,line,expected",
    [('"', '1|"a ""b"" | c"', 'a "b" | c'), ("\\", '1|"a \\"b\\" | c"', 'a "b" | c')],
)
def test_quoting_dialects(spark, tmp_path, escape, line, expected):
    (tmp_path / "f.csv").write_text(f"i|t\n{line}\n")
    df = read_delimited(spark, str(tmp_path), ["i", "t"], sep="|", escape=escape)
    assert rows(df) == [("1", expected)]


def test_ids_keep_their_zeros_and_several_paths_are_one_table(spark, tmp_path):
    for name, value in (("a.csv", "00360305"), ("b.csv", "1")):
        (tmp_path / name).write_text(f"CNPJ\n{value}\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert rows(read_delimited(spark, paths, ["cnpj"], sep="\t")) == [("00360305",), ("1",)]


def test_layers_and_typed_tables(spark, workspace):
    df = spark.createDataFrame([("A", "x" * 10, 3)], "nome string, segmento string, n bigint")
    write_layer(spark.range(5).toDF("n"), workspace.path, "delivery", "one")
    write_layer(df, workspace.path, "delivery", "one")
    write_layer(df, workspace.path, "delivery", "two.parquet")
    assert rows(read_layer(spark, workspace.path, "delivery", "one")) == rows(df)
    assert list_layer(spark, workspace.path, "delivery") == ["one", "two.parquet"]
    for mode, expected in (("overwrite", 1), ("overwrite", 1), ("append", 2)):
        tables = load_layer(
            spark, workspace.path, "delivery", workspace.folder("wh"), prefix="t_src_", mode=mode
        )
        assert tables == {"one": "t_src_one", "two": "t_src_two"}
        assert spark.table("t_src_two").count() == expected
    long_text = df.withColumn("texto", F.lit("x" * 70_000))
    load_table(long_text, "t_src_long", workspace.folder("wh/long"), widths={"segmento": 30})
    assert spark.table("t_src_long").filter("length(texto) = 70000").count() == 1
    wide = df.withColumn("segmento", F.lit("x" * 11))
    with pytest.raises(Exception, match="(?i)exceeds|length"):
        load_table(wide, "t_src_one", workspace.folder("wh/one"))


def test_a_batch_that_is_loaded_again_adds_nothing(spark, workspace):
    def load(batch, data, **options):
        df = spark.createDataFrame(data, "nome string, n bigint")
        write_layer(df, workspace.path, "delivery", "b")
        return load_layer(
            spark, workspace.path, "delivery", workspace.folder("wh"), prefix="t_batch_",
            mode="append", batch=batch, **options,
        )["b"]

    load("2021-1", [("A", 1), ("A", 1), ("B", 2)])
    load("2021-2", [("C", 3)])
    table = load("2021-1", [("A", 1), ("A", 1), ("B", 2)])
    assert rows(spark.table(table)) == [
        ("A", 1, "2021-1"), ("A", 1, "2021-1"), ("B", 2, "2021-1"), ("C", 3, "2021-2")
    ]
    load("2021-1", [("D", 4)])  # a corrected batch replaces itself only
    assert rows(spark.table(table)) == [("C", 3, "2021-2"), ("D", 4, "2021-1")]
    load("2021-2", spark.createDataFrame([], "nome string, n bigint").collect())
    assert rows(spark.table(table)) == [("D", 4, "2021-1")]
    with pytest.raises(ValueError, match="letters"):
        load("x'); drop", [("A", 1)])
    with pytest.raises(Exception, match="(?i)exceeds|length"):
        load("2021-3", [("A" * 501, 1)])
    assert rows(spark.table(table)) == [("D", 4, "2021-1")]
    plain = spark.createDataFrame([("A", 1)], "nome string, n bigint")
    load_table(plain, "t_batch_plain", workspace.folder("wh/plain"))
    with pytest.raises(ValueError, match="no batches"):
        load_batch(plain, "t_batch_plain", workspace.folder("wh/plain"), "1")
    with pytest.raises(ValueError, match="mode"):
        load_layer(spark, workspace.path, "delivery", workspace.folder("wh"), batch="1")


def test_header_is_checked_and_fields_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('X;Y\n"one\ntwo";2\n')
    read = [spark, str(tmp_path / "a.csv"), ["x", "y"]]
    got = read_delimited(*read, sep=";", multi_line=True, expected_header=["X", "Y"])
    assert [tuple(r) for r in got.collect()] == [("one\ntwo", "2")]
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(*read, sep=";", multi_line=True, expected_header=["Y", "X"]).collect()


def test_a_table_is_read_in_one_task_only_on_request(spark):
    with pytest.raises(ValueError, match="split"):
        read_jdbc(spark, "jdbc:none:x", "t", {})


def test_workspace_deletes_itself(spark):
    with Workspace(spark) as own:
        path = own.path
        own.keep(spark.range(3), "x")
    with pytest.raises(Exception):
        spark.read.parquet(f"{path}/x")


def test_jdbc_options(spark):
    df = spark.createDataFrame([], "nome string, url string, n bigint, d double, x decimal(11,2)")
    types = "`nome` VARCHAR(500), `url` VARCHAR(65535), `n` BIGINT, `d` DOUBLE PRECISION, `x` DECIMAL(11,2)"
    assert jdbc_column_types(df) == types
    split = JdbcSplit("id", "0", "100", 4)
    assert jdbc_read_options("u", "t", {"user": "me"}, split, 500) == {
        "url": "u", "dbtable": "t", "fetchsize": "500", "user": "me",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    common = {"url": "u", "dbtable": "t", "batchsize": "1000"}
    recreate = jdbc_write_options(df, "u", "t", {}, keep_definition=False, batch_rows=1000, widths=None)
    assert recreate == common
    keep = jdbc_write_options(df, "u", "t", {}, keep_definition=True, batch_rows=1000, widths={})
    assert keep["truncate"] == "true" and "VARCHAR(65535)" in keep["createTableColumnTypes"]


def test_scratch_is_the_configured_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert scratch_root(spark) == before.rstrip("/")
        assert Workspace(spark).path.startswith(before.rstrip("/"))
    assert Workspace(spark).path != Workspace(spark).path


def test_a_failed_publication_leaves_the_old_version(spark, workspace, monkeypatch):
    base, old, new = workspace.path, spark.range(3).toDF("n"), spark.range(5).toDF("n")
    broken = new.select(F.when(F.col("n") < 4, F.col("n")).otherwise(F.raise_error(F.lit("no"))).alias("n"))

    def stored():
        return sorted(r.n for r in read_layer(spark, base, "trusted", "d").collect())

    write_layer(new, base, "trusted", "d")
    publish_layer(old, base, "trusted", "d")
    assert stored() == [0, 1, 2]
    assert all(p.startswith(("_", ".")) for p in os.listdir(f"{base}/trusted/d"))
    with pytest.raises(Exception):
        publish_layer(broken, base, "trusted", "d")  # while rows are written
    assert stored() == [0, 1, 2]

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(writers, "replace_text", stopped)  # between the steps
        publish_layer(new, base, "trusted", "d")
    assert stored() == [0, 1, 2]
    reading = read_layer(spark, base, "trusted", "d")
    publish_layer(new, base, "trusted", "d")
    assert stored() == [0, 1, 2, 3, 4]
    assert reading.count() == 3  # the version before stays readable
    assert list_layer(spark, base, "trusted") == ["d"]
    publish_layer(old, base, "trusted", "d")
    versions = [p for p in os.listdir(f"{base}/trusted/d/_versions") if not p.startswith(".")]
    assert len(versions) == 2 and stored() == [0, 1, 2]
    publish_layer(read_layer(spark, base, "trusted", "d"), base, "trusted", "d")
    assert stored() == [0, 1, 2]
