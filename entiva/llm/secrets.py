r"""Secret scan: fixed rules, and strings that look random to two character Markov models.

One model learns the character transitions of random strings, from the values that the rules
find; the other those of ordinary identifiers, from words of a sample of documents. A long
run of identifier characters is reported if its log-likelihood ratio favours the first.
Everything is a built-in expression: a text is split by a pattern for the gaps and
searched for the matches, and running lengths give the places in code points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import text_or_empty

#: Rules in the order of their kinds. Fixed by the contract.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run is as long as it can be, so a shorter one fails as a whole
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Characters of candidates; code 0 stands for the start of a string.
ALPHABET = "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
SIZE = 128

SPANS = "array<struct<start:int,kind:int,end:int>>"


#: Outputs are gathered in stretches of so many, these in stretches of as many, and so on.
STRETCH, LEVELS = 32, 3


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def scanned(items: Column, zero: Column, step, kind: str) -> Column:
    """What ``step`` (of state and item: new state, output) gives for each item, in order.

    An array grows by copying, so outputs are gathered in short stretches, which are joined level
    by level: the work is in proportion to the items.
    """

    def stretch(state: Column, items: Column, first: Column, level: int) -> Column:
        """State after, and outputs of, the items from ``first`` to the end of the stretch."""
        size = STRETCH**level
        last = F.size(items) - 1
        if level <= LEVELS:
            last = F.least(last, first + size - 1)
        start = F.struct(
            state.alias("state"), F.array().cast(kind if level == 1 else f"array<{kind}>").alias("out")
        )

        def one(own: Column, place: Column) -> Column:
            if level == 1:
                after, output = step(own["state"], F.get(items, place))
                return F.struct(after.alias("state"), F.array_append(own["out"], output).alias("out"))
            return bound(
                stretch(own["state"], items, place, level - 1),
                lambda p: F.struct(
                    p["state"].alias("state"), F.array_append(own["out"], p["out"]).alias("out")
                ),
            )

        def joined(own: Column) -> Column:
            out = own["out"] if level == 1 else F.flatten(own["out"])
            return F.struct(own["state"].alias("state"), out.alias("out"))

        return F.aggregate(F.sequence(first, last, F.lit(size // STRETCH)), start, one, joined)

    def run(items: Column) -> Column:
        whole = stretch(zero, items, F.lit(0), LEVELS + 1)["out"]
        return F.when(F.size(items) > 0, whole).otherwise(F.array().cast(kind))

    return bound(items, run)


def spans_of(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Places of the matches of ``pattern`` that ``keep`` (of match and number) accepts."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    accepted = F.transform(matches, lambda _: F.lit(True)) if keep is None else keep(text, matches)

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return end, F.when(pair["keep"], span)

    pairs = F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"),
        matches.alias("match"),
        accepted.alias("keep"),
    )
    found = F.array_compact(scanned(pairs, F.lit(0), step, SPANS))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPANS))


def apart(runs: Column, base: Column) -> Column:
    """The ``runs`` that overlap no span of ``base``: two passes over both in order of place,
    for spans that start no later, and for those that start later."""
    def is_run(span: Column) -> Column:
        return span["kind"] == KINDS.index("random")

    def forward(end: Column, span: Column) -> tuple[Column, Column]:
        held = F.when(is_run(span), end).otherwise(F.greatest(end, span["end"]))
        return held, F.when(~is_run(span) | (span["start"] >= end), span)

    def backward(start: Column, span: Column) -> tuple[Column, Column]:
        held = F.when(is_run(span), start).otherwise(span["start"])
        return held, F.when(is_run(span) & (span["end"] <= start), span)

    ahead = scanned(F.array_sort(F.concat(base, runs)), F.lit(0), forward, SPANS)
    last = F.lit((1 << 31) - 1)
    behind = scanned(F.reverse(F.array_compact(ahead)), last, backward, SPANS)
    free = F.reverse(F.array_compact(behind))
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), free).otherwise(runs)


def long_values(text: Column, matches: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.transform(values, lambda v: F.length(v) >= LEAST_VALUE)


@dataclass
class RatioModel:
    """Log-likelihood ratio of each transition (rows: previous code, columns: next code)."""

    ratios: list[float]

    def column(self) -> Column:
        return F.split(F.lit(",".join(f"{r:.4f}" for r in self.ratios)), ",").cast("array<double>")


def transitions(samples: DataFrame) -> DataFrame:
    """Counts of ``before, after`` (character codes) by ``random`` over the texts ``value``."""
    codes = F.transform(F.split("value", ""), F.ascii)
    pairs = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.size(codes) - 1)).alias("before"),
        codes.alias("after"),
    )
    return (
        samples.filter(F.length("value") > 0)
        .select("random", F.explode(pairs).alias("pair"))
        .groupBy("random", "pair.before", "pair.after")
        .count()
    )


def fit(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_values: int = 20_000,
    sample_documents: int = 2_000,
    smoothing: float = 0.5,
) -> RatioModel | None:
    """Train both models from labelled samples of ``documents``; None if a label has none.

    Random: at most ``sample_values`` values that the rules find, those of lowest hash. Ordinary:
    at most ``sample_values`` words of eight or more letters, from about ``sample_documents``
    documents drawn by a hash of the id. What reaches the driver are the counts of
    transitions, bounded by the square of the alphabet.
    """
    texts = documents.select(
        F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")
    )
    of_rules = texts.filter(F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).select(
        F.explode(
            F.array_union(
                F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
                F.array_union(
                    F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
                    F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
                ),
            )
        ).alias("value"),
        F.lit(True).alias("random"),
    )
    of_rules = of_rules.filter(F.length("value") >= 16)
    rows = texts.count()
    drawn = F.pmod(F.xxhash64("id"), F.lit(max(1, rows // sample_documents))) == 0
    words = F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9_])[A-Za-z_]{8,64}"), F.lit(0))
    of_words = texts.filter(drawn).select(
        F.explode(words).alias("value"), F.lit(False).alias("random")
    )
    samples = [
        s.withColumn("value", F.regexp_replace("value", r"[^A-Za-z0-9+/_=-]", ""))
        .distinct()
        .orderBy(F.xxhash64("value"), "value")
        .limit(sample_values)
        for s in (of_rules, of_words)
    ]
    counts: dict[bool, dict[tuple[int, int], int]] = {True: {}, False: {}}
    for row in transitions(samples[0].unionByName(samples[1])).collect():
        counts[row["random"]][row["before"], row["after"]] = row["count"]
    if not counts[True] or not counts[False]:
        return None
    codes = [ord(c) for c in ALPHABET]
    ratios = [0.0] * (SIZE * SIZE)
    for before in [0, *codes]:
        logs = []
        for own in (counts[True], counts[False]):
            total = sum(own.get((before, a), 0) for a in codes) + smoothing * len(codes)
            logs.append([math.log((own.get((before, a), 0) + smoothing) / total) for a in codes])
        for after, yes, no in zip(codes, *logs, strict=True):
            ratios[before * SIZE + after] = yes - no
    return RatioModel(ratios)


def ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a string of the alphabet's characters."""
    zero = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def step(state: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.struct(
            code.alias("before"),
            (state["sum"] + F.get(table, state["before"] * SIZE + code)).alias("sum"),
        )

    return F.aggregate(F.split(token, ""), zero, step, lambda state: state["sum"])


def secrets(
    documents: DataFrame,
    model: RatioModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_ratio: float = 8.0,
) -> DataFrame:
    """``doc_id, base, added`` of every row: arrays of ``start, kind, end`` in code points.

    ``base`` holds what the rules find, ordered by start and kind; ``added`` runs of 16 or
    more identifier characters, a letter among them, whose log-likelihood ratio is at least
    ``least_ratio`` and that overlap no base span. Null counts as empty and has no spans; without a model
    nothing is added. Rows are independent: repeated ones get the same answer.
    """
    text = F.col("text")
    rows = documents.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).select(
        "doc_id",
        "text",
        spans_of(text, ASSIGN, 0, long_values).alias("assign"),
        spans_of(text, ACCESS, 1).alias("access"),
        spans_of(text, HEX, 2).alias("hex"),
    )
    base = F.array_sort(F.concat("assign", "access", "hex"))
    if model is None:
        return rows.select("doc_id", base.alias("base"), F.array().cast(SPANS).alias("added"))
    table = model.column()

    def unlike_words(_: Column, matches: Column) -> Column:
        # numbers alone are no keys
        return F.transform(
            matches, lambda m: m.rlike("[A-Za-z]") & (ratio(m, table) >= least_ratio)
        )

    rows = rows.select(
        "doc_id", base.alias("base"), spans_of(text, CANDIDATE, 3, unlike_words).alias("runs")
    )
    free = apart(F.col("runs"), F.col("base"))
    return rows.select("doc_id", "base", free.alias("added"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans in writing."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
