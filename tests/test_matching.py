import hashlib
import random

import pytest
from pyspark.sql import functions as F

from entiva.functions.similarity import common_subsequences, letter_marks, weighted_ratio
from entiva.operators import segments
from entiva.operators.assign import one_to_one
from entiva.operators.match import (
    best_per_left,
    comparable,
    levenshtein_pairs,
    match_names,
    placed,
)
from entiva.operators.weighted import (
    SHARED_WORD,
    index_names,
    weighted_best,
    weighted_candidates,
    weighted_matcher,
)
from entiva.session import Workspace


def names(spark, texts):
    return spark.createDataFrame([(t, t) for t in sorted(set(texts))], "name string, text string")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def score(a, b):
    longer = max(len(a), len(b))
    return (longer - edit_distance(a, b)) * 100 // longer


def random_texts(seed, count, alphabet, longest):
    """Random texts over few letters, and edited copies, so that many pairs are close."""
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        if texts and rng.random() < 0.6:
            chars = list(rng.choice(texts))
            for _ in range(rng.randint(1, 2)):
                place = rng.randrange(len(chars) + 1)
                chars[place:place + rng.randint(0, 1)] = rng.choice(["", rng.choice(alphabet)])
            text = " ".join("".join(chars).split())
        else:
            text = " ".join(
                "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))).split()
            )
        if text:
            texts.append(text)
    return texts


def brute_pairs(left, right, cutoff):
    return sorted(
        (a, b, score(a, b)) for a in set(left) for b in set(right) if score(a, b) >= cutoff
    )


@pytest.mark.parametrize("growth", [(1000, 256), (0, 0)], ids=["one round", "all rounds"])
@pytest.mark.parametrize(
    "cutoff,seed", [(0, 7), (30, 6), (50, 5), (70, 4), (80, 2), (90, 3), (100, 1)]
)
def test_edit_distance_pairs_equal_brute_force(spark, workspace, monkeypatch, cutoff, seed, growth):
    monkeypatch.setattr(segments, "PAIRS_PER_NAME", growth[0])
    monkeypatch.setattr(segments, "PAIRS_PER_KEY", growth[1])
    left, right = random_texts(seed, 90, "AB ", 14), random_texts(seed + 50, 90, "AB ", 14)
    got = levenshtein_pairs(names(spark, left), names(spark, right), cutoff, workspace, "p")
    assert sorted(map(tuple, got.collect())) == brute_pairs(left, right, cutoff)


@pytest.mark.parametrize("cutoff", [50, 80])
def test_pairs_of_long_texts_equal_brute_force(spark, workspace, monkeypatch, cutoff):
    """Some with more edits than cuts are listed for, some around that bound."""
    monkeypatch.setattr(segments, "MOST_EDITS", 5)
    left, right = random_texts(21, 60, "ABC ", 40), random_texts(71, 60, "ABC ", 40)
    left, right = left + right[:9], right + [t + "X" * (len(t) // 8) for t in left[:9]]
    got = levenshtein_pairs(names(spark, left), names(spark, right), cutoff, workspace, "p")
    assert sorted(map(tuple, got.collect())) == brute_pairs(left, right, cutoff)


def test_cutoffs_out_of_range_are_refused(spark, workspace):
    for cutoff in (-1, 101):
        with pytest.raises(ValueError):
            levenshtein_pairs(names(spark, ["A"]), names(spark, ["A"]), cutoff, workspace, "q")


def institutions(count, seed):
    """Names with one of four first words, of which some letters of each copy are changed."""
    rng = random.Random(seed)
    kinds = ["BANCO", "CREDITO", "COOPERATIVA", "INSTITUICAO"]
    texts = [f"{kinds[i % 4]} {rng.getrandbits(56):014X}" for i in range(count)]
    edited = []
    for text in texts:
        chars = list(text)
        for _ in range(2):
            chars[rng.randrange(len(chars))] = rng.choice("0123456789ABCDEF")
        edited.append("".join(chars))
    return texts, edited


@pytest.mark.parametrize("cutoff", [80, 90])
def test_ten_times_the_names_are_compared_in_at_most_fifteen_times_the_pairs(
    spark, workspace, cutoff
):
    """Signatures grow in both sizes; the names share four first words, a quarter each."""
    compared = []
    for count in (400, 4000):
        left, right = institutions(count, 3)
        found = segments.candidates(
            names(spark, left), names(spark, right), cutoff, workspace, f"n{count}", 20, 16
        )
        compared.append(comparable(found, cutoff).count())
        assert found.filter("left_text = right_text").count() <= 3 * count
    assert compared[0] >= 400 and compared[1] <= 15 * compared[0]


def test_letter_marks_bound_the_edit_distance(spark):
    texts = random_texts(5, 60, "AB\u00e9\u0410 Z9", 30) + ["", "A" * 200]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    marks = {r.t: r.m for r in frame.select("t", letter_marks(F.col("t")).alias("m")).collect()}
    for a in texts:
        for b in texts:
            unlike = sum(
                bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(marks[a], marks[b])
            )
            assert unlike <= 2 * edit_distance(a, b) - abs(len(a) - len(b))


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ("THIS IS A TEST", "THIS IS A TEST", 100.0),
        ("THIS IS A TEST", "THIS IS A NEW TEST", 95.0),
        ("BANCO DO BRASIL", "BRASIL BANCO DO", 95.0),
        ("ITAU", "ITAU UNIBANCO", 90.0),
        ("BANCO X", "BANCO YZW QRS", 85.5),
        ("", "BANCO", 0.0),
        ("AB", "AXB", 80.0),
        ("ABCD", "WXYZ", 0.0),
    ],
)
def test_weighted_ratio_of_known_pairs(a, b, expected):
    assert weighted_ratio(a, b) == pytest.approx(expected)
    assert weighted_ratio(b, a) == pytest.approx(expected)


def brute_best(left, right, cutoff):
    best = {}
    for a in set(left):
        scored = [(-weighted_ratio(a, b), b) for b in set(right)]
        top = min((s, b) for s, b in scored)
        if -top[0] >= cutoff:
            best[a] = (top[1], -top[0])
    return best


@pytest.mark.parametrize(
    "alphabet,longest,cutoff,seed",
    [("AB ", 8, 80, 1), ("ABC  ", 12, 80, 2), ("ABCDEF ", 10, 80, 3), ("ABCD ", 14, 90, 4),
     ("AB ", 5, 85, 5), ("ABCDEFGH   ", 20, 80, 6)],
)
def test_weighted_best_equals_brute_force(spark, workspace, alphabet, longest, cutoff, seed):
    left = random_texts(seed, 120, alphabet, longest)
    right = random_texts(seed + 90, 120, alphabet, longest)
    got = weighted_best(names(spark, left), names(spark, right), cutoff, workspace, "w").collect()
    assert {r["left"]: (r["right"], r["score"]) for r in got} == brute_best(left, right, cutoff)
    assert len(got) == len({r["left"] for r in got})


def test_few_pairs_of_names_from_few_words_are_scored(spark, workspace):
    words = [["SMALL", "LARGE", "RED", "BLUE", "OLD", "NEW", "HOT", "COLD"],
             ["ROD", "RING", "BOLT", "GEAR", "PLATE", "ANVIL", "GIZMO", "WIDGET"]]
    texts = [f"BRAND{i} {a} {b}" for i in range(1, 11) for a in words[0] for b in words[1]]
    frame = names(spark, texts)
    index = index_names(frame, frame, workspace, "few")
    for cutoff in (80, SHARED_WORD):
        found = weighted_candidates(frame, frame, cutoff, index).distinct()
        assert len(texts) <= found.count() <= len(texts) ** 2 / 10


@pytest.mark.parametrize(
    "alphabet,longest", [("AB ", 9), ("ABCDEFGHIJ \u00e9\u0410", 150), ("AB", 70)]
)
def test_common_subsequences_equal_the_table(alphabet, longest):
    texts = random_texts(8, 90, alphabet, longest) + ["", "A" * 64, "A" * 65, "AB" * 64]
    rng = random.Random(2)
    pairs = [(rng.choice(texts), rng.choice(texts)) for _ in range(300)]

    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    found = common_subsequences([a for a, _ in pairs], [b for _, b in pairs])
    assert found.tolist() == [table(a, b) for a, b in pairs]


def sequential_greedy(pairs):
    def rank(pair):
        a, b, s = pair
        return -s, hashlib.md5(f"{a}\u0001{b}".encode()).hexdigest()[:15], a, b

    used_left, used_right, taken = set(), set(), []
    for a, b, s in sorted(pairs, key=rank):
        if a not in used_left and b not in used_right:
            used_left.add(a)
            used_right.add(b)
            taken.append((a, b, s))
    return sorted(taken)


@pytest.mark.parametrize("parts", [1, 37])
def test_one_to_one_equals_sequential_greedy(spark, workspace, parts):
    rng = random.Random(9)
    pairs = {(f"l{rng.randrange(40)}", f"r{rng.randrange(30)}") for _ in range(400)}
    scored = sorted((a, b, rng.choice([80, 85, 90])) for a, b in pairs)
    df = spark.createDataFrame(scored, "left string, right string, score int").repartition(parts)
    got = sorted(map(tuple, one_to_one(df, workspace, "a").collect()))
    assert got == sequential_greedy(scored)


def test_a_round_writes_open_names_and_pairs_are_written_once(spark, workspace, monkeypatch):
    rng = random.Random(3)
    pairs = {(f"l{rng.randrange(200)}", f"r{rng.randrange(200)}") for _ in range(4000)}
    scored = sorted((a, b, rng.choice([80, 85, 90])) for a, b in pairs)
    written, keep = [], Workspace.keep

    def counted(self, df, label, by=None):
        found = keep(self, df, label, by)
        written.append((label, found.count()))
        return found

    monkeypatch.setattr(Workspace, "keep", counted)
    df = spark.createDataFrame(scored, "left string, right string, score int")
    got = sorted(map(tuple, one_to_one(df, workspace, "a").collect()))
    assert got == sequential_greedy(scored)
    assert [n for label, n in written if "pairs" in label] == [len(scored)]
    open_names = [n for label, n in written if "best" in label]
    assert open_names[0] == len({a for a, _ in pairs}) + len({b for _, b in pairs})
    assert open_names[-1] == 0 and len(open_names) > 3
    assert all(later < before for before, later in zip(open_names, open_names[1:]))


def test_one_to_one_of_nothing(spark, workspace):
    empty = spark.createDataFrame([], "left string, right string, score int")
    assert one_to_one(empty, workspace, "a").count() == 0


def test_best_per_left_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("a", "z", 90), ("a", "b", 90), ("a", "c", 80)], "left string, right string, score int"
    )
    assert [tuple(r) for r in best_per_left(df).collect()] == [("a", "b", 90)]


def test_aliases_come_before_similar_names(spark, workspace):
    left = spark.createDataFrame(
        [("BANCO DO BRASIL",), ("BANCO DO BRASIL",), ("BANCO FIBRA",), ("",), (None,)],
        "nome_norm string",
    )
    right = spark.createDataFrame(
        [("BB",), ("BANCO DO BRASIX",), ("BANCO FIBRAS",), ("",)], "nome_norm string"
    )
    got = match_names(
        left, right, name="nome_norm", cutoff=80, workspace=workspace, label="m"
    ).collect()
    assert sorted((r["nome_norm"], r["candidate"], r["kind"]) for r in got) == [
        ("BANCO DO BRASIL", "BB", "alias"), ("BANCO FIBRA", "BANCO FIBRAS", "similar")
    ]


def test_two_names_of_one_canonical_name_keep_both_candidates(spark, workspace):
    left = spark.createDataFrame([("ITAU",), ("ITAU UNIBANCO",)], "n string")
    right = spark.createDataFrame([("ITAU",), ("ITAU UNIBANCO",)], "n string")
    got = match_names(left, right, name="n", cutoff=80, workspace=workspace, label="m").collect()
    assert sorted((r["n"], r["candidate"]) for r in got) == [
        ("ITAU", "ITAU"), ("ITAU UNIBANCO", "ITAU UNIBANCO")
    ]


def test_many_names_of_one_canonical_name_are_numbered_in_several_tasks(spark, workspace):
    rows = [(f"N{i * 7919 % 3000:04}", "MANY") for i in range(3000)] + [
        (f"X{i:04}", f"FEW {i % 400}") for i in range(1200)
    ]
    df = spark.createDataFrame(rows, "name string, text string").repartition(7)
    got = placed(df, workspace, "p", stretch_names=100)
    expected = {}
    for text in {t for _, t in rows}:
        for place, name in enumerate(sorted(n for n, t in rows if t == text), 1):
            expected[text, name] = place
    assert {(r["text"], r["name"]): r["place"] for r in got.collect()} == expected
    assert got.count() == len(expected)
    stretches = spark.read.parquet(workspace.folder("p-stretches")).groupBy("stretch").count()
    assert stretches.count() > 15  # the ranges are drawn by a sample
    assert stretches.agg(F.max("count")).first()[0] < 600
    none = placed(df.limit(0), workspace, "none", stretch_names=100)
    assert none.count() == 0 and none.columns == got.columns


def test_weighted_matcher_is_one_to_one_and_leaves_no_pair_open(spark, workspace):
    rng = random.Random(4)
    words = ["BANCO", "CREDITO", "NORTE", "SUL", "LESTE", "FINANCEIRA", "X"]
    make = lambda: " ".join(rng.sample(words, rng.randint(1, 4)))
    left, right = {make() for _ in range(40)}, {make() + " Q" for _ in range(25)}
    got = weighted_matcher(
        names(spark, left), names(spark, right), 80, workspace, "w"
    ).collect()
    used_left, used_right = {r["left"] for r in got}, {r["right"] for r in got}
    assert len(used_left) == len(used_right) == len(got) > 0
    assert all(r["score"] == pytest.approx(weighted_ratio(r["left"], r["right"])) for r in got
               if r["score"] != SHARED_WORD)
    open_pairs = [
        (a, b) for a in left - used_left for b in right - used_right if weighted_ratio(a, b) >= 80
    ]
    assert open_pairs == []


def test_pairs_do_not_depend_on_partitioning(spark, workspace):
    texts = random_texts(11, 60, "ABC ", 12)
    a = names(spark, texts)
    one = levenshtein_pairs(a.repartition(1), a, 80, workspace, "one")
    many = levenshtein_pairs(a.repartition(37), a.repartition(5), 80, workspace, "many")
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    assert one.filter(F.col("left") == F.col("right")).count() == a.count()
