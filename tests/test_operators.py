import pytest
from pyspark.sql import functions as F

from entiva.operators import quality
from entiva.operators.aggregate import (
    aggregate_by_both_keys,
    aggregate_by_either_key,
    aggregate_by_key,
    branch,
)
from entiva.operators.dedup import dedup_by_key_priority, dedup_by_name, keep_first, split_by_key
from entiva.operators.lookup import (
    SPREAD,
    backfill,
    first_present,
    frequent_keys,
    lookup,
    matched,
    matched_values,
    unmatched,
)
from entiva.operators.shape import (
    cast_losses,
    column_at,
    drop_all_null,
    fix_types,
    rename_positional,
    require_widths,
    select_present,
    union_by_name,
    width_report,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_positional_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y", "c"]
    assert df.select(column_at(df, 2)).first()[0] == 3
    with pytest.raises(ValueError):
        rename_positional(df, ["x", "y", "z", "w"])


def test_drop_all_null_and_select_present(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    assert drop_all_null(df).columns == ["a", "c"]
    assert select_present(df, ["c", "zz", "a"]).columns == ["c", "a"]


def test_types_and_widths(spark):
    df = spark.createDataFrame([("1.239", "abcdef"), ("x", "ab")], "n string, t string")
    kinds = {"n": "decimal(11,2)"}
    assert [str(r[0]) for r in fix_types(df, kinds).orderBy("t").collect()] == ["None", "1.24"]
    assert cast_losses(df, kinds).first()["n"] == 1
    assert width_report(df, {"t": 3}).first()["t"] == 1
    assert require_widths(df, {"t": 6}).count() == 2
    with pytest.raises(Exception, match="exceeds 3 characters"):
        require_widths(df, {"t": 3}).collect()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "s")], "i int, segmento string")
    b = spark.createDataFrame([(2, "c")], "i int, cnpj string")
    assert rows(union_by_name([a, b])) == [(1, "s", None), (2, None, "c")]


def registry(spark):
    return spark.createDataFrame(
        [("7", "A", 3), ("7", "A", 1), ("", "A", 2), (None, "A", 5), ("", "B", 4), ("8", "A", 6)],
        "cnpj_norm string, nome_norm string, v int",
    )


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup_has_a_fixed_winner(spark, parts):
    df = registry(spark).repartition(parts)
    # No id: the row with a null id sorts before the one with an empty id.
    assert rows(dedup_by_key_priority(df)) == [
        ("", "B", 4), ("7", "A", 1), ("8", "A", 6), (None, "A", 5)
    ]
    assert rows(dedup_by_name(df, order=[-F.col("v")])) == [
        ("", "B", 4), ("8", "A", 6)
    ]
    assert keep_first(df, ["nome_norm"], ["v"]).columns == df.columns


def test_split_loses_no_row(spark):
    with_id, without_id = split_by_key(registry(spark), "cnpj_norm")
    assert (with_id.count(), without_id.count()) == (3, 3)


def facts(spark):
    return spark.createDataFrame(
        [("1", "A", 10), ("1", "B", None), ("", "A", 5), (None, "C", 2), ("", "", 9), ("2", "", 1)],
        "id string, name string, n int",
    )


def test_aggregates_by_id_name_either_and_both(spark):
    measures = {"total": F.sum("n"), "n": F.count(F.lit(1))}
    df = facts(spark)
    assert rows(aggregate_by_key(df, "id", measures, "c_")) == [("1", 10, 2), ("2", 1, 1)]
    assert rows(aggregate_by_key(df, "name", measures)) == [("A", 15, 2), ("B", None, 1),
                                                            ("C", 2, 1)]
    either = aggregate_by_either_key(df, "id", "name", measures)
    assert rows(branch(either, "id", "k")) == [("1", 10, 2), ("2", 1, 1)]
    assert rows(branch(either, "name", "k")) == [("A", 5, 1), ("C", 2, 1)]
    both = aggregate_by_both_keys(df, "id", "name", measures)
    assert rows(branch(both, "id", "k")) == [("1", 10, 2), ("2", 1, 1)]
    assert rows(branch(both, "name", "k")) == [("A", 15, 2), ("B", None, 1), ("C", 2, 1)]


def test_lookup_takes_one_partner_and_no_empty_key(spark):
    left = spark.createDataFrame([("a", 1), ("", 2), (None, 3), ("z", 4)], "k string, i int")
    right = spark.createDataFrame([("a", 9), ("a", 8), ("", 7), (None, 6)], "k string, v int")
    assert rows(lookup(left, right, key="k")) == [
        ("", 2, None), ("a", 1, 8), ("z", 4, None), (None, 3, None)
    ]
    assert rows(unmatched(left, right, "k")) == [("", 2), ("z", 4), (None, 3)]
    assert rows(matched(left, right, "k")) == [("a", 1)]


def test_frequent_keys_change_no_result(spark):
    left = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "").otherwise(
            F.concat(F.lit("k"), F.col("id"))
        ).alias("k"),
        "id",
    )
    right = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3)], "k string, v int")
    found = frequent_keys(left, "k")
    assert found == ["hot"]
    plain = lookup(left, right, key="k", right_is_unique=True)
    spread = lookup(left, right, key="k", right_is_unique=True, frequent=found)
    assert spread.count() == 60_000
    assert spread.filter("v = 1").count() == 20_000
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert f"{SPREAD - 1}" in plan or "explode" in plan


def test_backfill_keeps_rows_and_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "name string, v int")
    candidates = spark.createDataFrame([("A", 5), ("B", None)], "name string, v int")
    matches = spark.createDataFrame([("a", "A"), ("b", "B")], "name string, candidate string")
    values = matched_values(matches, candidates, "name", ["v"], "m_")
    got = backfill(df, values, name="name", columns=["v"], prefix="m_")
    assert rows(got) == [("a", 1), ("a", 5), ("b", None)]
    both = first_present(df.withColumn("w", F.lit(3)), {"v": ["v", "w"]})
    assert both.columns == ["name", "v"] and both.filter("v is null").isEmpty()


def test_reports(spark):
    df = spark.createDataFrame([("a��", 1), ("b", None), ("", 2)], "t string, n int")
    assert rows(quality.replacement_chars(df, ["t"])) == [("t", 2, 1)]
    assert rows(quality.coverage(df, "t", "n")) == [(3, 3, 2, 2)]
    assert rows(quality.key_completeness(df, "t")) == [(3, 1, 1 / 3)]
    assert rows(quality.layer_counts({"x": df, "y": df.limit(1)})) == [("x", 3), ("y", 1)]
    top = quality.ranked(df, required=["n"], by="n", then="t", columns=["t"], limit=1)
    assert rows(top) == [("",)]
    rules = {"plain": (F.col("t"), F.col("t")), "cut": (F.substring("t", 1, 1), F.col("t"))}
    assert rows(quality.match_uplift(df, df, rules)) == [("cut", 1), ("plain", 2)]
