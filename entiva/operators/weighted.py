"""Matching by the weighted ratio, without comparing all names with all names.

Texts are normalised names: words separated by single spaces. Each word is cut into
bigrams of itself with a space at both ends, so word order does not matter, and a text of
``m`` characters has ``m + 1`` bigrams. Let ``m`` belong to the shorter text of a pair.

* A full ratio of ``c`` or more, over the words in any order, leaves at most ``3 (1 - c) m``
  of its bigrams unshared: a deletion costs two, an insertion one.
* A partial ratio of ``p`` or more leaves at most ``4 (1 - p) / (2 - p) m`` unshared, and
  two more at the ends of the window.

So one of its rarest bigrams, one more than that number, is shared, and pairs are found by
an equi-join on those. Two cases share no bigram and are handled apart: a single letter
inside a longer word, and a common word in texts of unequal length. The latter gives
``SHARED_WORD`` to every such pair, far too many to list when a word is frequent; they are
found through an index of one name per word and length.

A pair that meets under a bigram is scored if its letters allow the score: a common
subsequence is no longer than what two texts have in common letter by letter, which two
numbers per name and a count of bits bound (``letter_marks``). Where only common words could
give the score, their lengths are added up first.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.functions.similarity import (
    PARTIAL_SCALE,
    TOKEN_SCALE,
    UNEQUAL_FROM,
    VERY_UNEQUAL_ABOVE,
    letter_marks,
    unlike_letters,
    weighted_scores,
)
from entiva.operators.assign import one_to_one
from entiva.operators.match import (
    best_per_left,
    bucket,
    gram_frequencies,
    match_in_steps,
    numbered,
    spread_names,
    without,
)
from entiva.session import Workspace

# The score of two texts of unequal length that have a word in common and no better claim.
SHARED_WORD = TOKEN_SCALE * PARTIAL_SCALE * 100.0
LOWEST_CUTOFF = 80


def _words(text: Column) -> Column:
    return F.split(text, " ")


def _distinct_length(text: Column) -> Column:
    return F.length(F.array_join(F.array_distinct(_words(text)), " "))


def _bigrams(words: Column) -> Column:
    return F.flatten(
        F.transform(
            words,
            lambda word: F.transform(
                F.sequence(F.lit(1), F.length(word) + F.lit(1)),
                lambda i: F.substring(F.concat(F.lit(" "), word, F.lit(" ")), i, F.lit(2)),
            ),
        )
    )


def _most_unshared(length: Column, cutoff: float) -> Column:
    """Most bigrams of a shorter text of this length that a similar text may lack."""
    full = F.floor(F.lit(3 * (1 - cutoff / 100)) * length + F.lit(1e-9))
    partial = cutoff / 100 / PARTIAL_SCALE
    if partial > 1:
        return full.cast("int")
    windowed = F.floor(F.lit(4 * (1 - partial) / (2 - partial)) * length + F.lit(1e-9)) + F.lit(2)
    return F.greatest(full, windowed).cast("int")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with an array column that is computed once a row. What a lambda refers to is
    otherwise computed again for each element; the optimizer does not look through a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _grams(names: DataFrame) -> DataFrame:
    """One row per name and bigram; ``first_word_use`` marks those of distinct words."""
    words = _words(F.col("text"))
    rows = _once(names, "words", words)
    rows = _once(rows, "raw", _bigrams(F.col("words")))
    rows = _once(rows, "raw_once", _bigrams(F.array_distinct("words")))
    rows = _once(rows, "keys", numbered(F.col("raw")))
    rows = _once(rows, "keys_once", numbered(F.col("raw_once")))
    marked = F.transform(
        "keys",
        lambda key: F.struct(
            key.alias("gram"), F.array_contains("keys_once", key).alias("first_word_use")
        ),
    )
    return rows.select("is_left", "name", "text", F.inline(marked))


def index_names(left: DataFrame, right: DataFrame, workspace: Workspace, label: str) -> DataFrame:
    """One row per side and name: lengths, letters, and all its bigrams, rarest first.

    Whatever the cutoff and whichever names are still open, the same index serves.
    """
    sides = [
        names.select(F.lit(is_left).alias("is_left"), "name", "text")
        for is_left, names in ((True, left), (False, right))
    ]
    grams = workspace.keep(
        _grams(spread_names(sides[0].unionByName(sides[1]))), f"{label}-grams"
    )
    frequencies = workspace.keep(gram_frequencies(grams), f"{label}-frequencies")
    ordered = F.array_sort(F.collect_list(F.struct("n", "gram", "first_word_use")))
    return workspace.keep(
        grams.withColumn("bucket", bucket(F.col("gram")))
        .join(F.broadcast(frequencies), "bucket")
        .groupBy("is_left", "name", "text")
        .agg(ordered.alias("ordered"))
        .select(
            "*",
            F.length("text").alias("length"),
            _distinct_length(F.col("text")).alias("distinct_length"),
            _letters(_words(F.col("text"))).alias("all"),
            _letters(F.array_distinct(_words(F.col("text")))).alias("once"),
            F.transform("ordered", lambda g: g["gram"]).alias("grams"),
        ),
        f"{label}-index",
    )


def _probes(index: DataFrame, cutoff: float) -> DataFrame:
    """The index with the rare bigrams to probe with, and how many of its bigrams a longer text
    must share."""
    length, distinct = F.col("length"), F.col("distinct_length")
    rare = F.slice("ordered", F.lit(1), _most_unshared(length, cutoff) + 1)
    rare_distinct = F.slice(
        F.filter("ordered", lambda g: g["first_word_use"]),
        F.lit(1),
        _most_unshared(distinct, cutoff) + 1,
    )
    return index.withColumns(
        {
            "rare": F.array_union(
                F.transform(rare, lambda g: g["gram"]),
                F.transform(rare_distinct, lambda g: g["gram"]),
            ),
            "needed": F.greatest(
                F.lit(1),
                F.least(
                    length + 1 - _most_unshared(length, cutoff),
                    distinct + 1 - _most_unshared(distinct, cutoff),
                ),
            ),
        }
    ).drop("ordered", "is_left")


def _letters(words: Column) -> Column:
    """Number of words and of letters in them, and the letters' marks."""
    letters = F.array_join(words, "")
    return F.struct(
        F.size(words).alias("words"),
        F.length(letters).alias("letters"),
        letter_marks(letters).alias("marks"),
    )


def _unlike(kind: str) -> Column:
    return unlike_letters(F.col(f"s.{kind}.marks"), F.col(f"t.{kind}.marks"))


def _most_common(kind: str) -> Column:
    """No common subsequence of the two texts is longer."""
    letters = (F.col(f"s.{kind}.letters") + F.col(f"t.{kind}.letters") - _unlike(kind)) / 2
    return letters + F.least(F.col(f"s.{kind}.words"), F.col(f"t.{kind}.words")) - 1


def _may_score(cutoff: float) -> Column:
    """Whether letters and common words of ``s`` and ``t`` allow the score."""

    def alike(size: str, kind: str, scale: float) -> Column:
        """A ratio over whole texts, which unlike letters lower one by one."""
        share = 1 - cutoff / scale / 100
        return _unlike(kind) <= share * (F.col(f"s.{size}") + F.col(f"t.{size}")) + 1e-9

    def covered(size: str, scale: float) -> Column:
        """How much of the shorter text must be common for a ratio to it."""
        needed = cutoff / scale
        shorter = F.least(f"s.{size}", f"t.{size}")
        return F.lit(needed / max(200 - needed, 1e-9)) * shorter - 1e-9

    words = F.array_intersect(_words(F.col("s.text")), _words(F.col("t.text")))
    common = F.length(F.array_join(words, " "))
    by_words = covered("distinct_length", TOKEN_SCALE)
    near = (
        alike("distinct_length", "once", TOKEN_SCALE)
        | ((_most_common("once") >= by_words) & (common >= by_words))
    )
    far = F.lit(False)
    if cutoff <= 100 * PARTIAL_SCALE:
        far = (_most_common("all") >= covered("length", PARTIAL_SCALE)) | (
            _most_common("once") >= covered("distinct_length", TOKEN_SCALE * PARTIAL_SCALE)
        )
    is_near = _length_ratio(F.col("s.length"), F.col("t.length")) < UNEQUAL_FROM
    return alike("length", "all", 1.0) | F.when(is_near, near).otherwise(far)


def _length_ratio(a: Column, b: Column) -> Column:
    return F.greatest(a, b).cast("double") / F.least(a, b)


def _probe(short: DataFrame, long: DataFrame, cutoff: float) -> DataFrame:
    """Candidate pairs in which ``short`` is the shorter text, once each: a pair is produced
    at the first of the rare bigrams that the other text holds."""
    s = short.select("*", F.posexplode("rare").alias("place", "gram")).alias("s")
    t = long.withColumn("gram", F.explode("grams")).drop("ordered", "is_left").alias("t")
    not_longer = (F.col("s.length") <= F.col("t.length")) | (
        F.col("s.distinct_length") <= F.col("t.distinct_length")
    )
    shared_earlier = F.arrays_overlap(F.slice("s.rare", F.lit(1), F.col("s.place")), "t.grams")
    enough = F.size(F.array_intersect("s.grams", "t.grams")) >= F.col("s.needed")
    comparable = _length_ratio(F.col("s.length"), F.col("t.length")) <= VERY_UNEQUAL_ABOVE
    # from cheap to dear
    return s.join(
        t,
        (F.col("s.gram") == F.col("t.gram"))
        & not_longer
        & comparable
        & _may_score(cutoff)
        & ~shared_earlier
        & enough,
    ).select(
        F.col("s.name").alias("s"), F.col("s.text").alias("s_text"),
        F.col("t.name").alias("t"), F.col("t.text").alias("t_text"),
    )


def _single_letters(short: DataFrame, long: DataFrame) -> DataFrame:
    """Pairs of a name that is one letter and the texts that hold it."""
    s = short.select(
        F.col("name").alias("s"), F.col("text").alias("s_text"),
        F.substring("text", 1, 1).alias("letter"),
    ).filter(_distinct_length(F.col("s_text")) == 1)
    t = long.select(
        F.col("name").alias("t"), F.col("text").alias("t_text"),
        F.explode(F.array_distinct(F.split("text", ""))).alias("letter"),
    )
    comparable = _length_ratio(F.length("s_text"), F.length("t_text")) <= VERY_UNEQUAL_ABOVE
    return s.join(t, "letter").filter(comparable).select("s", "s_text", "t", "t_text")


def weighted_candidates(
    left: DataFrame, right: DataFrame, cutoff: float, index: DataFrame
) -> DataFrame:
    """The pairs to score: ``left, left_text, right, right_text``. ``index`` is that of the
    names (``index_names``) and may hold more names than are wanted here."""
    if not LOWEST_CUTOFF <= cutoff <= 100:
        raise ValueError(f"cutoff {cutoff} is not between {LOWEST_CUTOFF} and 100")
    a = index.filter("is_left").join(left.select("name", "text"), ["name", "text"], "left_semi")
    b = index.filter("not is_left").join(right.select("name", "text"), ["name", "text"], "left_semi")
    forward = ["s AS left", "s_text AS left_text", "t AS right", "t_text AS right_text"]
    backward = ["t AS left", "t_text AS left_text", "s AS right", "s_text AS right_text"]
    return (
        _probe(_probes(spread_names(a), cutoff), b, cutoff).selectExpr(*forward)
        .unionAll(_probe(_probes(spread_names(b), cutoff), a, cutoff).selectExpr(*backward))
        .unionAll(_single_letters(left, right).selectExpr(*forward))
        .unionAll(_single_letters(right, left).selectExpr(*backward))
    )


def weighted_pairs(
    left: DataFrame, right: DataFrame, cutoff: float, index: DataFrame
) -> DataFrame:
    """The pairs that score ``cutoff`` or more, but for those that only share a word.

    Those score ``SHARED_WORD``; see ``shared_word_best``. The score is computed in Arrow
    batches, for candidate pairs only.
    """
    candidates = weighted_candidates(left, right, cutoff, index)
    # a pair of equally long texts is found from both sides
    return weighted_scores(candidates.distinct()).filter(F.col("score") >= cutoff)


def _by_word(names: DataFrame) -> DataFrame:
    return names.select(
        "name", F.length("text").alias("length"),
        F.explode(F.array_distinct(_words(F.col("text")))).alias("word"),
    )


def _unequal(a: Column, b: Column) -> Column:
    return _length_ratio(a, b).between(UNEQUAL_FROM, VERY_UNEQUAL_ABOVE)


def shared_word_best(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per left name the first right name, in name order, with a word in common and a
    length unequal enough; its score is ``SHARED_WORD``.

    The right side is reduced to one name per word and length, so a frequent word costs no
    more rows than there are lengths.
    """
    index = _by_word(right).groupBy("word", "length").agg(F.min("name").alias("right"))
    found = _by_word(left).alias("l").join(index.alias("r"), "word")
    return (
        found.filter(_unequal(F.col("l.length"), F.col("r.length")))
        .groupBy(F.col("l.name").alias("left"))
        .agg(F.min("right").alias("right"))
        .withColumn("score", F.lit(SHARED_WORD))
    )


def weighted_best(
    left: DataFrame, right: DataFrame, cutoff: float, workspace: Workspace, label: str
) -> DataFrame:
    """The best candidate of every left name: highest score, then first in name order."""
    pairs = weighted_pairs(left, right, cutoff, index_names(left, right, workspace, label))
    if cutoff <= SHARED_WORD:
        pairs = pairs.unionByName(shared_word_best(left, right))
    return best_per_left(pairs)


def _shared_word_offers(
    left: DataFrame, right: DataFrame, round_number: int, spread: bool
) -> DataFrame:
    """At most a few pairs per left name and word. With ``spread``, the right names of a
    word are dealt into as many slots as there are names and a left name looks into one
    slot; without it there is one slot, so that a name with any partner is offered one."""
    rights = _by_word(right)
    slots = rights.groupBy("word").agg(F.count(F.lit(1)).alias("slots")).withColumn(
        "slots", F.col("slots") if spread else F.lit(1).cast("bigint")
    )

    def dealt(names: DataFrame) -> DataFrame:
        number = F.xxhash64("name", "word", F.lit(round_number))
        return names.join(slots, "word").withColumn("slot", F.pmod(number, F.col("slots")))

    index = dealt(rights).groupBy("word", "slot", "length").agg(F.min("name").alias("right"))
    offers = dealt(_by_word(left)).alias("l").join(index.alias("r"), ["word", "slot"])
    return offers.filter(_unequal(F.col("l.length"), F.col("r.length"))).select(
        F.col("l.name").alias("left"), "right", F.lit(SHARED_WORD).alias("score")
    )


def shared_word_one_to_one(
    left: DataFrame, right: DataFrame, workspace: Workspace, label: str
) -> DataFrame:
    """One-to-one matching over the pairs that share a word, all of one score.

    Rounds of offers, each settled best first. A round that settles nothing is followed by
    one without spreading; if that finds no offer, no pair is left.
    """
    spread, number, settled = True, 0, False
    while True:
        offers = workspace.keep(
            _shared_word_offers(left, right, number, spread), f"{label}-offers-{number}"
        )
        empty = offers.isEmpty()
        if not empty:
            found = workspace.keep(
                one_to_one(offers, workspace, f"{label}-round-{number}"),
                f"{label}-found/round={number}",
            )
            settled = True
            left = workspace.keep(without(left, found, "left"), f"{label}-l-{number}")
            right = workspace.keep(without(right, found, "right"), f"{label}-r-{number}")
        elif not spread:
            break
        spread, number = not empty, number + 1
    return workspace.rounds(f"{label}-found") if settled else offers


def weighted_matcher(
    left: DataFrame, right: DataFrame, cutoff: float, workspace: Workspace, label: str
) -> DataFrame:
    """One-to-one matching by the weighted ratio, a ``Matcher`` for ``match_names``.

    Steps: pairs above or at ``SHARED_WORD`` that letters find, pairs that share a word,
    pairs below. Among equal scores letters therefore go before a shared word.
    """
    index = index_names(left, right, workspace, label)

    def by_letters(lowest: float, step: str):
        return lambda a, b: one_to_one(
            weighted_pairs(a, b, lowest, index), workspace, f"{label}-{step}"
        )

    steps = [by_letters(max(cutoff, SHARED_WORD), "strict")]
    if cutoff <= SHARED_WORD:
        steps.append(lambda a, b: shared_word_one_to_one(a, b, workspace, f"{label}-words"))
        steps.append(by_letters(cutoff, "loose"))
    return match_in_steps(left, right, steps, workspace, label)
