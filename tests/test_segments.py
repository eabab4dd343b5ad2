"""Signatures of segments: where cuts lie, and how much is dealt to find the pairs."""

import pytest
from pyspark.sql import functions as F

from entiva.operators import segments
from entiva.operators.match import levenshtein_pairs
from entiva.session import Workspace
from tests.test_matching import brute_pairs, institutions, names, random_texts


@pytest.mark.parametrize("most", [(30, 1 << 16), (1 << 24, 5)], ids=["pairs", "texts"])
@pytest.mark.parametrize("cutoff,seed", [(50, 15), (80, 12), (90, 13)])
def test_signatures_too_frequent_for_a_task_lose_no_pair(
    spark, workspace, monkeypatch, cutoff, seed, most
):
    monkeypatch.setattr(segments, "PAIRS_PER_NAME", 0)
    monkeypatch.setattr(segments, "PAIRS_PER_KEY", 4)
    monkeypatch.setattr(segments, "TASK_PAIRS", most[0])
    monkeypatch.setattr(segments, "TASK_TEXTS", most[1])
    left, right = random_texts(seed, 70, "AB ", 14), random_texts(seed + 50, 110, "AB ", 14)
    for a, b in ((left, right), (right, left)):
        got = levenshtein_pairs(names(spark, a), names(spark, b), cutoff, workspace, "p")
        assert sorted(map(tuple, got.collect())) == brute_pairs(a, b, cutoff)


def test_names_of_one_text_all_get_its_pairs(spark, workspace):
    left = spark.createDataFrame([("A", "BANCO"), ("B", "BANCO")], "name string, text string")
    right = names(spark, ["BANCO", "BANCOS"])
    got = levenshtein_pairs(left, right, 80, workspace, "t")
    assert sorted(map(tuple, got.collect())) == [
        (a, b, score) for a in "AB" for b, score in (("BANCO", 100), ("BANCOS", 83))
    ]


def written_rows(spark, path):
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = files.option("pathGlobFilter", "*.parquet").load(path).select("path")
    return spark.read.parquet(*[r.path for r in files.collect()]).select(F.lit(1)).count()


def test_growing_signatures_are_not_written_and_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(segments, "PAIRS_PER_NAME", 20)
    monkeypatch.setattr(segments, "PAIRS_PER_KEY", 16)
    left, right = institutions(4000, 3)
    workspace = Workspace(spark)
    pairs = levenshtein_pairs(names(spark, left), names(spark, right), 80, workspace, "w")
    assert pairs.count() >= 4000
    # both sides' texts once, and at most a key for each signature of a text on the cut side
    assert written_rows(spark, workspace.path) <= 8000 + 4000 * 12


def test_a_common_first_word_is_no_segment(spark, workspace):
    sides = segments._sides(names(spark, institutions(400, 5)[0]), names(spark, ["A"]))
    told = segments.told_bits(sides, {(True, 20)})[True, 20]
    cuts = segments.even_segments(told, 0, 20, 4)
    assert cuts[0][1] > len("BANCO ") and sum(size for _, size in cuts) == 20
    assert all(2 <= size <= 4 for _, size in cuts[1:])
