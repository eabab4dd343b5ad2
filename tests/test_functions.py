import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from entiva.functions.aliases import INSTITUTION_ALIASES, alias_table, resolve_aliases
from entiva.functions.keys import (
    LEGAL_SUFFIXES,
    key_present,
    normalize_id,
    normalize_name,
    normalize_name_by_pattern,
    only_keyed,
)
from entiva.functions.numbers import (
    exact_mean,
    parse_decimal_comma,
    ratio,
    to_double,
    to_long,
    whole_to_long,
)


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


NAMES = {
    "BRADESCO - PRUDENCIAL": "BRADESCO",
    "CREDIT SUISSE (conglomerado)": "CREDIT SUISSE",
    "BANCO FIBRA S.A.": "BANCO FIBRA",
    "CAIXA ECONÔMICA FEDERAL": "CAIXA ECONOMICA FEDERAL",
    "  Société   Générale ": "SOCIETE GENERALE",
    "AF PARAN�": "AF PARAN",
    "FIRMA LTDA": "FIRMA",
}


def test_literal_name_rule(spark):
    names = NAMES | {"BANCO DAYCOVAL S.A": "BANCO DAYCOVAL SA", "½ ﬁm™": "12 FIMTM", None: ""}
    assert apply(spark, normalize_name, list(names)) == list(names.values())


def test_pattern_name_rule(spark):
    names = NAMES | {"BANCO DAYCOVAL S.A": "BANCO DAYCOVAL", "ESPAÑA S/A": "ESPAA", None: ""}
    assert apply(spark, normalize_name_by_pattern, list(names)) == list(names.values())


def test_name_rules_delete_odd_characters_without_a_regex_class(spark):
    names = {
        "A\u0000B\tC\x7f": "ABC",
        "A--B..A--B": "ABAB",
        "𝐀B 🏦 C漢": "B C",
        "½ 漢 É": "12 E",
        "\\^$[]Z": "Z",
        "": "",
        "- &": "",
    }
    assert apply(spark, normalize_name, list(names)) == list(names.values())
    assert apply(spark, normalize_name_by_pattern, ["A\u0000B\tC\x7f", "½ É 🏦"]) == ["ABC", "E"]
    # searching one took six times as long as the rest of the rule
    df = spark.createDataFrame([("a",)], "v string").select(normalize_name(F.col("v")))
    assert "[^" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_folding_equals_nfkd_on_every_bmp_character(spark):
    def plain(value):
        value = value.strip().upper()
        for suffix in LEGAL_SUFFIXES:
            value = value.replace(suffix, "")
        value = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
        return re.sub(" +", " ", re.sub("[^A-Z0-9 ]", "", value)).strip()

    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    values = [f"a{chr(c)}b {chr(c)}" for c in codes]
    got = apply(spark, normalize_name, values)
    assert [c for c, v, g in zip(codes, values, got) if plain(v) != g] == []


def test_ids(spark):
    ids = {"00360305": "360305", "360305": "360305", "0": "", " ": "", None: "", "1.2/3-0": "1230"}
    assert apply(spark, normalize_id, list(ids)) == list(ids.values())
    assert apply(spark, lambda c: normalize_id(c), [360305, None], "bigint") == ["360305", ""]


def test_key_presence_is_never_null(spark):
    values = ["x", "", None]
    assert apply(spark, key_present, values) == [True, False, False]
    assert apply(spark, lambda c: ~key_present(c), values) == [False, True, True]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    assert only_keyed(df, "k").count() == 1


def test_locale_numbers(spark):
    values = {"15,52": 15.52, "14.015,05": 14015.05, " ": None, "": None, "x": None, None: None,
              "1 000,5": 1000.5}
    assert apply(spark, parse_decimal_comma, list(values)) == list(values.values())


def test_safe_casts(spark):
    assert apply(spark, to_long, ["52.0", "52", "x", "", None, "7.9"]) == [52, 52, None, None,
                                                                          None, 7]
    assert apply(spark, to_double, ["3.8", " ", "x", None]) == [3.8, None, None, None]


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 4)], "a int, b int")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 0.25, None]
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "k string, v double")
    got = dict(df.groupBy("k").agg(exact_mean(F.col("v"))).collect())
    assert got == {"a": 0.3 / 2, "b": None}
    df = spark.createDataFrame([(0.004,), (0.004,)], "v double")
    assert df.agg(exact_mean(F.col("v"))).first()[0] == 0.004
    extremes = {"small": [1e-11, 3e-11], "large": [1e30], "mixed": [1e30, 1e-11, None, 2.5],
                "thirds": [1 / 3, 2 / 3, 100 / 3], "whole": [1e18, 3e18], "huge": [1.7e308],
                "tiny": [5e-324], "cancel": [1e22, 0.5, -1e22, 1e-20]}
    expected = {"small": 2e-11, "large": 1e30, "mixed": 1e30 / 3, "thirds": (103 / 3) / 3,
                "whole": 2e18, "huge": 1.7e308, "tiny": 5e-324, "cancel": 0.125}
    rows = [(k, v) for k, vs in extremes.items() for v in vs]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, v double").repartition(3)
        got = dict(df.groupBy("k").agg(exact_mean(F.col("v"))).collect())
        assert got == pytest.approx(expected, rel=1e-15, abs=0)
    many = spark.range(20_000).selectExpr(
        "pmod(xxhash64(id), 1000003) / 1000.0D / (1 + id % 7) as v")
    means = {many.repartition(n, "v").agg(exact_mean(F.col("v"))).first()[0] for n in (1, 3, 8)}
    assert len(means) == 1
    odd = ["NaN", "Infinity", "-Infinity", "0,004"]
    assert apply(spark, parse_decimal_comma, odd) == [None, None, None, 0.004]
    assert apply(spark, to_double, odd[:3]) == [None] * 3


def test_whole_to_long_fails_on_a_fraction(spark):
    assert apply(spark, lambda c: whole_to_long(c, "v"), [3.0, None], "double") == [3, None]
    with pytest.raises(Exception, match="not a whole number"):
        apply(spark, lambda c: whole_to_long(c, "v"), [3.5], "double")


def test_aliases(spark):
    assert len(INSTITUTION_ALIASES) == 88
    df = spark.createDataFrame([("BB",), ("OTHER",), (None,), ("BB",)], "n string")
    got = sorted(map(tuple, resolve_aliases(df, "n", "c").collect()), key=str)
    assert got == [("BB", "BANCO DO BRASIL")] * 2 + [("OTHER", "OTHER"), (None, None)]
    many = spark.range(150_000).selectExpr("concat('A', id) as nome", "concat('C', id) as canonico")
    got = resolve_aliases(spark.createDataFrame([("A149999",)], "n string"), "n", "c", many)
    assert got.first()["c"] == "C149999"
    assert alias_table(spark, {}).count() == 0
