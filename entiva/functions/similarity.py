"""Name similarity scores, 0 to 100."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The scorer travels to the Python workers by value, so that executors which do not have
# this package installed can run it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def levenshtein_allowance(longer: Column, cutoff: int) -> Column:
    """Edits that still score ``cutoff`` or more when the longer text has this length."""
    return F.floor(longer * F.lit(100 - cutoff) / F.lit(100)).cast("int")


def levenshtein_score(distance: Column, longer: Column) -> Column:
    """Whole-number score: the share of the longer text that needs no edit, rounded down."""
    return F.floor((longer - distance) * F.lit(100) / longer).cast("int")


# Characters are counted in classes, up to a highest count each: one bit per class and count.
CLASSES, HIGHEST = 32, 4


def letter_marks(text: Column) -> Column:
    """How often a text has the characters of each class, as two numbers of 64 bits.

    A class that occurs ``n`` times has the lowest ``n`` of its bits set, ``HIGHEST`` at most.
    """
    chars = F.filter(F.split(text, ""), lambda char: char != "")
    codes = F.transform(chars, lambda char: F.ascii(char) % CLASSES)
    half = CLASSES // 2

    def counted(marks: Column, code: Column, first: int) -> Column:
        place = (code - first) * HIGHEST
        held = F.call_function("shiftrightunsigned", marks, place).bitwiseAND(F.lit(7))
        more = F.call_function("shiftleft", held * 2 + 1, place)
        return F.when(code.between(first, first + half - 1), marks.bitwiseOR(more)).otherwise(marks)

    none = F.struct(F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"))
    return F.aggregate(
        codes,
        none,
        lambda marks, code: F.struct(
            counted(marks["low"], code, 0).alias("low"),
            counted(marks["high"], code, half).alias("high"),
        ),
    )


def unlike_letters(a: Column, b: Column) -> Column:
    """At most the number of characters that one of two texts has and the other lacks; a
    substitution adds two to it, an insertion or deletion one."""
    return F.bit_count(a["low"].bitwiseXOR(b["low"])) + F.bit_count(
        a["high"].bitwiseXOR(b["high"])
    )


# Fixed values of the weighted ratio: scale of token scores, scale of partial scores, and
# the length ratios from which partial scores count and from which they count little.
TOKEN_SCALE = 0.95
PARTIAL_SCALE = 0.9
VERY_UNEQUAL_SCALE = 0.6
UNEQUAL_FROM = 1.5
VERY_UNEQUAL_ABOVE = 8.0


#: Numbers of 64 bits in the tables of one block of pairs, and windows scored at once.
TABLE_SIZE, WINDOWS = 1 << 17, 1 << 17


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the length of each text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.fromiter(map(len, texts), np.int64, len(texts))


def _matrix(codes: np.ndarray, lengths: np.ndarray, fill: int) -> np.ndarray:
    """One row per text, filled up behind its end."""
    rows = np.full((len(lengths), int(lengths.max(initial=0))), fill, np.int64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = codes
    return rows


def common_subsequences(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a[0]`` and ``b[0]``, and so on.

    All pairs go forward together by one character of ``b``; a pair's row of the usual table is
    one bit per character of its ``a``, in as many numbers as the longest ``a`` needs.
    """
    points_a, lengths_a = _codes(a)
    points_b, lengths_b = _codes(b)
    points = np.concatenate([points_a, points_b])
    number = np.zeros(int(points.max(initial=0)) + 1, np.int64)
    number[points] = 1
    number = np.cumsum(number) - 1
    codes = number[points]
    kinds, parts = int(number[-1]) + 2, max(1, -(-int(lengths_a.max(initial=0)) // 64))
    rows_a = _matrix(codes[: len(points_a)], lengths_a, kinds - 1)
    rows_b = _matrix(codes[len(points_a) :], lengths_b, kinds - 1)
    found = np.zeros(len(a), np.int64)
    step = max(1, TABLE_SIZE // (kinds * parts))
    for begin in range(0, len(a), step):
        own = slice(begin, begin + step)
        found[own] = _block_subsequences(rows_a[own], lengths_a[own], rows_b[own], kinds, parts)
    return found


def _block_subsequences(
    a: np.ndarray, lengths: np.ndarray, b: np.ndarray, kinds: int, parts: int
) -> np.ndarray:
    each = np.arange(len(a))
    places = np.zeros((len(a), kinds, parts), np.uint64)
    for i in range(a.shape[1]):
        places[each, a[:, i], i // 64] |= np.uint64(1 << (i % 64))
    places[:, kinds - 1] = 0  # what fills up the rows matches nothing
    row = np.full((len(a), parts), np.iinfo(np.uint64).max, np.uint64)
    for j in range(b.shape[1]):
        hits = places[each, b[:, j]]
        kept = row & ~hits
        total = row + (row & hits)
        if parts > 1:
            _carry(row, total)
        row = total | kept
    bits = np.arange(parts * 64).reshape(parts, 64)
    inside = (bits < lengths[:, None, None]).astype(np.uint64)
    mask = (inside << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
    return np.bitwise_count(~row & mask).sum(axis=1).astype(np.int64)


def _carry(before: np.ndarray, total: np.ndarray) -> None:
    """Add to each part of the sums what the part below it carries over."""
    carry = np.zeros(len(total), np.uint64)
    for part in range(total.shape[1]):
        over = total[:, part] < before[:, part]
        total[:, part] += carry
        carry = (over | (total[:, part] < carry)).astype(np.uint64)


def _ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    total = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    common = common_subsequences(a, b)
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


def _windows(short: str, long: str) -> list[str]:
    """Parts of ``long`` that are as long as ``short``, and shorter ones at its ends."""
    size = len(short)
    return list({long[max(i, 0) : i + size] for i in range(1 - size, len(long))})


def _partial_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Best ratio of the shorter text against any window of the longer one."""
    best = np.zeros(len(a))
    shorts: list[str] = []
    windows: list[str] = []
    rows: list[int] = []

    def score() -> None:
        if rows:
            np.maximum.at(best, rows, _ratios(shorts, windows))
        shorts.clear(), windows.clear(), rows.clear()

    for row, (x, y) in enumerate(zip(a, b, strict=True)):
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        if not short or short in long:
            best[row] = 100.0 if short or not long else 0.0
            continue
        looked_at = [(short, w) for w in _windows(short, long)]
        if len(short) == len(long):
            looked_at += [(long, w) for w in _windows(long, short)]
        for text, window in looked_at:
            shorts.append(text)
            windows.append(window)
            rows.append(row)
        if len(rows) >= WINDOWS:
            score()
    score()
    return best


def weighted_ratios(lefts: Sequence[str], rights: Sequence[str]) -> np.ndarray:
    """The weighted ratio of pairs of names, built from its published definition.

    The best of the plain ratio, the token-sort and token-set ratios, and, for texts of
    unequal length, their partial forms, each at its scale.
    """
    sorted_words = {t: sorted(t.split()) for t in {*lefts, *rights}}
    distinct = {t: set(words) for t, words in sorted_words.items()}
    joined = {t: " ".join(words) for t, words in sorted_words.items()}
    shared = [distinct[a] & distinct[b] for a, b in zip(lefts, rights, strict=True)]
    only_a = [" ".join(sorted(distinct[a] - s)) for a, s in zip(lefts, shared, strict=True)]
    only_b = [" ".join(sorted(distinct[b] - s)) for b, s in zip(rights, shared, strict=True)]
    in_order_a, in_order_b = [joined[a] for a in lefts], [joined[b] for b in rights]
    size_a, size_b = (
        np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (lefts, rights)
    )
    longer, shorter = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    unequal = longer / np.maximum(shorter, 1)
    scores = _ratios(lefts, rights)
    worded = np.array([bool(a and b) for a, b in zip(in_order_a, in_order_b)], bool)
    scores[shorter == 0] = 0.0
    near = np.flatnonzero(worded & (unequal < UNEQUAL_FROM))
    far = np.flatnonzero(worded & (unequal >= UNEQUAL_FROM))

    def of(texts: list[str], rows: np.ndarray) -> list[str]:
        return [texts[i] for i in rows]

    if len(near):
        by_order = _ratios(of(in_order_a, near), of(in_order_b, near))
        by_set = _token_set_ratios(of(shared, near), of(only_a, near), of(only_b, near))
        scores[near] = np.maximum(scores[near], TOKEN_SCALE * np.maximum(by_order, by_set))
    if len(far):
        scale = np.where(unequal[far] <= VERY_UNEQUAL_ABOVE, PARTIAL_SCALE, VERY_UNEQUAL_SCALE)
        by_token = np.full(len(far), 100.0)
        rest = np.array([not shared[i] for i in far], bool)
        if rest.any():
            other = far[rest]
            by_token[rest] = np.maximum(
                _partial_ratios(of(in_order_a, other), of(in_order_b, other)),
                _partial_ratios(of(only_a, other), of(only_b, other)),
            )
        partial = _partial_ratios([lefts[i] for i in far], [rights[i] for i in far])
        scores[far] = np.maximum(
            scores[far], np.maximum(scale * partial, TOKEN_SCALE * scale * by_token)
        )
    return scores


def _token_set_ratios(shared: list[set[str]], a: list[str], b: list[str]) -> np.ndarray:
    common = np.array([sum(map(len, s)) + max(len(s) - 1, 0) for s in shared], np.int64)
    gap = np.array([bool(s) for s in shared], np.int64)
    only_a, only_b = (np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (a, b))
    length_a, length_b = common + gap + only_a, common + gap + only_b
    edits = only_a + only_b - 2 * common_subsequences(a, b)
    best = 100.0 * (1 - edits / (length_a + length_b))
    for length in (length_a, length_b):
        best = np.where(gap > 0, np.maximum(best, 200.0 * common / (common + length)), best)
    return np.where((gap > 0) & ((only_a == 0) | (only_b == 0)), 100.0, best)


def weighted_ratio(a: str, b: str) -> float:
    """The weighted ratio of one pair."""
    return float(weighted_ratios([a], [b])[0])


def weighted_scores(pairs: DataFrame) -> DataFrame:
    """``left, right, score`` of pairs with ``left_text`` and ``right_text``, in batches.

    A map, not a function: a condition on the score would make Spark compute one twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = weighted_ratios(batch["left_text"].to_list(), batch["right_text"].to_list())
            yield batch[["left", "right"]].assign(score=scores)

    return pairs.mapInPandas(run, "left string, right string, score double")
