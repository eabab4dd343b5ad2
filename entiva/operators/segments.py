"""Pairs of texts within an edit distance, by signatures that grow until they are rare.

One text of a pair is cut, ``b`` characters with at most ``d`` edits; the other one moves. Cut
into ``d + 1`` segments, the first segment ``i`` up to whose end at most ``i`` edits occurred has
``i`` edits before it and none inside, so it stands unchanged in the other text, moved by ``i``
places at most, and ``d - i`` edits at most follow it. What lies before and behind are gaps with
edit budgets of their own, which can be cut in the same way. A signature is the sequence of
segments chosen so far. The cut text has one for every choice, the moving one for every choice
and every admissible move; a pair in reach shares one at every depth. The side with more names
is cut, so the moves are enumerated for the smaller one.

Cuts lie where segments tell texts apart about equally well, by how often two texts of that
length agree in a character if they agree in the one before: a first word that many names have
is then no segment of its own. The gap that grows next is the one whose segments tell most.

Signatures are dealt to tasks once. Those shared by more than a few pairs grow by a segment
within their task, where all of their texts are. Only signatures too frequent for a task grow
before that, in rounds, and those of them that cannot grow are joined. No signature is dropped.

Where the cuts lie depends on lengths and on these figures by length and place, not on a single
text. The driver lists them, and Spark joins the texts with that list.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce
from itertools import accumulate
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiva.functions.similarity import letter_marks
from entiva.session import Workspace

#: Signatures grow in rounds while they make more pairs than this for each name, and within a
#: task those that are shared by more pairs than that.
PAIRS_PER_NAME, PAIRS_PER_KEY = 1000, 256
#: A signature with more pairs, or with more texts of a side, is too frequent for one task.
TASK_PAIRS, TASK_TEXTS = 1 << 24, 1 << 16
#: Signatures dealt to a task, before they grow there.
TASK_ROWS = 250_000
#: Longer texts with more edits are cut once and joined on the segments' text; their list of
#: cuts and moves would be long.
MOST_EDITS = 20
#: Rows of a list of cuts that are sent to all tasks; a longer one is joined by a shuffle.
SENT_ROWS = 200_000
#: What a place tells at least, in bits, so that places which tell nothing are dealt evenly.
LEAST_BITS = 0.1

# A gap: where it begins and ends in the cut text, the same in the text that the signature
# is of, and its edit budget.
Gap = tuple[int, int, int, int, int]
# Bits that the places of a text before each place tell, from 0 to the text's length.
Bits = tuple[float, ...]
# A root: whether the left text is cut, its length, and the edits.
Root = tuple[bool, int, int]


def allowance(longer: int, cutoff: int) -> int:
    """Edits that still score ``cutoff`` or more when the longer text has this length."""
    return longer * (100 - cutoff) // 100


def segments(size: int, edits: int) -> list[tuple[int, int]]:
    """Begin and size of ``edits + 1`` segments, equal but for one character."""
    short, extra = divmod(size, edits + 1)
    cuts, begin = [], 0
    for i in range(edits + 1):
        cuts.append((begin, short + (i < extra)))
        begin += cuts[-1][1]
    return cuts


def even_segments(bits: Bits, begin: int, end: int, edits: int) -> list[tuple[int, int]]:
    """Begin and size of ``edits + 1`` segments of a gap longer than ``edits``, none empty, that
    tell about equally many bits."""
    cuts = [begin]
    for i in range(1, edits + 1):
        wanted = bits[begin] + (bits[end] - bits[begin]) * i / (edits + 1)
        at = bisect_left(bits, wanted, begin, end)
        if at > begin and wanted - bits[at - 1] < bits[at] - wanted:
            at -= 1
        cuts.append(min(max(at, cuts[-1] + 1), end - (edits + 1 - i)))
    return [(a, b - a) for a, b in zip(cuts, [*cuts[1:], end], strict=True)]


def open_gaps(gaps: list[Gap]) -> tuple[Gap, ...]:
    return tuple(g for g in gaps if g[1] - g[0] > g[4])


def grown(
    gaps: tuple[Gap, ...], moves: bool, bits: Bits
) -> list[tuple[int, int, int, tuple[Gap, ...], int, int]]:
    """The ways to add a segment: its number, its begin and size in the signature's text, the
    gaps then, and where and how long the gap's lead is. With ``moves`` the text is the one in
    which a segment may have moved.

    The lead is the first segment, unmoved, and of size 0 for that segment itself. Texts that
    agree in it meet under that segment, so under the others they need not.
    """
    chosen = max(gaps, key=lambda g: ((bits[g[1]] - bits[g[0]]) / (g[4] + 1), -g[0]))
    rest = [g for g in gaps if g is not chosen]
    begin, end, own, own_end, edits = chosen
    found = []
    parts = even_segments(bits, begin, end, edits)
    for i, (cut, size) in enumerate(parts):
        offset = cut - begin
        behind = end - cut - size
        for at in range(offset - i, offset + i + 1) if moves else (offset,):
            own_behind = own_end - own - at - size
            if at < 0 or own_behind < 0 or abs(own_behind - behind) > edits - i:
                continue
            before = (begin, cut, own, own + at, i)
            after = (cut + size, end, own + at + size, own_end, edits - i)
            lead = parts[0][1] if i else 0
            found.append((i, own + at, size, open_gaps([*rest, before, after]), own, lead))
    return found


class Cuts:
    """Numbers for the states that signatures are in: the text's role and its open gaps."""

    def __init__(self, spark: SparkSession, bits: dict[tuple[bool, int], Bits]):
        self.spark = spark
        self.bits = bits
        self.numbers: dict[tuple[Root, bool, tuple[Gap, ...]], int] = {}
        self.states: list[tuple[Root, bool, tuple[Gap, ...]]] = []

    def number(self, root: Root, moves: bool, gaps: tuple[Gap, ...]) -> int:
        state = (root, moves, gaps)
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def steps(
        self, root: Root, moves: bool, gaps: tuple[Gap, ...]
    ) -> list[tuple[int, int, int, int, bool, int, int]]:
        """Segment, begin (from 1), size, next state, whether that one can grow, and begin
        (from 1) and size of the lead."""
        return [
            (i, begin + 1, size, self.number(root, moves, then), bool(then), lead + 1, lead_size)
            for i, begin, size, then, lead, lead_size in grown(gaps, moves, self.bits[root[:2]])
        ]

    def steps_of(self, keys: DataFrame) -> list[tuple]:
        """A row for each way to grow each state that texts of these keys may be in, the number
        of the state first. Texts of a key differ in roles and moves only."""

        def cut(root: Root, _: bool, gaps: tuple[Gap, ...]) -> tuple:
            return root, tuple((begin, end, edits) for begin, end, _, _, edits in gaps)

        some = {cut(*self.states[r.state]) for r in keys.select("state").distinct().collect()}
        states = [s for s, state in enumerate(self.states) if cut(*state) in some]
        return [(s, *step) for s in states for step in self.steps(*self.states[s])]

    def table(self, rows: list[tuple], columns: str) -> DataFrame:
        frame = self.spark.createDataFrame(rows, columns)
        return F.broadcast(frame) if len(rows) <= SENT_ROWS else frame


STEP = "part int, begin int, size int, state int, open boolean, lead int, head int"


def roots(
    lefts: list[int], rights: list[int], cutoff: int, cut_left: bool
) -> tuple[dict[Root, list[int]], set[int]]:
    """The lengths that may move against each root, and the longer lengths that are left to
    ``by_one_segment``.

    The side ``cut_left`` tells is cut, unless its text is so short that its segments would be
    single characters; then the longer text is.
    """
    found: dict[Root, list[int]] = {}
    many = set()
    for left in lefts:
        for right in rights:
            edits = allowance(max(left, right), cutoff)
            if abs(left - right) > edits:
                continue
            if edits > MOST_EDITS:
                many.add(max(left, right))
                continue
            cut, moves = (left, right) if cut_left else (right, left)
            other = cut < moves and cut < 2 * (edits + 1)
            root = (cut_left != other, moves if other else cut, edits)
            found.setdefault(root, []).append(cut if other else moves)
    return found, many


def first_steps(cuts: Cuts, found: dict[Root, list[int]]) -> list[tuple]:
    """The first segment of every text by its side and length, for each root it takes part in."""
    rows = []
    for number, (root, lengths) in enumerate(sorted(found.items())):
        left_is_cut, cut, edits = root
        roles = [(left_is_cut, cut, False)] + [(not left_is_cut, n, True) for n in lengths]
        for is_left, length, moves in roles:
            gaps = open_gaps([(0, cut, 0, length, edits)])
            steps = cuts.steps(root, moves, gaps) if gaps else [(0, 1, 0, 0, False, 1, 0)]
            rows += [(is_left, length, number, *step) for step in steps]
    return rows


def told_bits(sides: DataFrame, wanted: set[tuple[bool, int]]) -> dict[tuple[bool, int], Bits]:
    """How well places tell texts of a side and length apart, summed up from the begin of a text.

    A place tells ``-log2`` of the share of equal characters there, of all pairs of texts that
    have the same character before. One row a place reaches the driver.
    """
    lengths = sides.sparkSession.createDataFrame(sorted(wanted), "is_left boolean, length int")
    two = F.transform(
        F.sequence(F.lit(1), F.col("length")),
        lambda i: F.substring("text", F.greatest(i - 1, F.lit(1)), F.least(i, F.lit(2))),
    )
    places = ["is_left", "length", "place"]
    shares = (
        sides.join(F.broadcast(lengths), ["is_left", "length"])
        .select("is_left", "length", F.posexplode(two).alias("place", "two"))
        .groupBy(*places, "two")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .withColumn("before", F.when(F.col("place") > 0, F.substring("two", 1, 1)))
        .groupBy(*places, "before")
        .agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("equal"))
        .groupBy(*places)
        .agg((F.sum("equal") / F.sum(F.col("all") * F.col("all"))).alias("share"))
    )
    told = {(r.is_left, r.length, r.place): -log2(min(r.share, 1.0)) for r in shares.collect()}
    return {
        (is_left, length): tuple(
            accumulate(
                (told.get((is_left, length, i), 0.0) + LEAST_BITS for i in range(length)),
                initial=0.0,
            )
        )
        for is_left, length in wanted
    }


def _sides(left: DataFrame, right: DataFrame) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            names.select("text")
            .distinct()
            .select(
                F.lit(is_left).alias("is_left"),
                "text",
                letter_marks(F.col("text")).alias("marks"),
                F.length("text").alias("length"),
            )
            for is_left, names in ((True, left), (False, right))
        ],
    )


def _signature(before: Column) -> Column:
    piece = F.substring(F.col("text"), F.col("begin"), F.col("size"))
    return F.xxhash64(before, "part", piece)


def signature_pairs(
    sides: DataFrame,
    cutoff: int,
    workspace: Workspace,
    label: str,
    pairs_per_name: int,
    pairs_per_key: int,
) -> tuple[list[DataFrame], set[int]]:
    """Candidate pairs that meet under a signature, and the lengths of longer texts that have
    none because of ``MOST_EDITS``."""
    lengths = sides.groupBy("is_left", "length").count().collect()
    lefts, rights = (
        sorted(r.length for r in lengths if r.is_left == is_left) for is_left in (True, False)
    )
    names = [sum(r["count"] for r in lengths if r.is_left == is_left) for is_left in (True, False)]
    most = pairs_per_name * sum(names)
    found, many = roots(lefts, rights, cutoff, names[0] > names[1])
    if not found:
        return [], many
    cuts = Cuts(sides.sparkSession, told_bits(sides, {root[:2] for root in found}))
    table = cuts.table(
        first_steps(cuts, found), f"is_left boolean, length int, root int, {STEP}"
    )
    columns = ["key", "is_left", "text", "marks", "state", "open", "head"]
    rows = sides.join(table, ["is_left", "length"])
    rows = rows.withColumn("key", _signature(F.col("root"))).select(*columns)
    pairs, number = [], 0
    while True:
        shared = workspace.keep(
            rows.groupBy("key")
            .agg(
                F.count_if("is_left").alias("lefts"),
                F.count_if(~F.col("is_left")).alias("rights"),
                F.bool_or("open").alias("open"),
                F.min("state").alias("state"),
            )
            .filter("lefts > 0 and rights > 0")
            .withColumn("pairs", F.col("lefts") * F.col("rights"))
            .withColumn(
                "large",
                (F.col("pairs") > TASK_PAIRS) | (F.greatest("lefts", "rights") > TASK_TEXTS),
            ),
            f"{label}-keys-{number}",
        )
        made = shared.agg(
            F.sum("pairs").alias("pairs"),
            F.count_if(F.col("large") & F.col("open")).alias("growing"),
            F.count_if("large").alias("large"),
            F.sum(F.when(~F.col("large"), F.col("lefts") + F.col("rights"))).alias("rows"),
        ).first()
        grows = bool(made.growing) and made.pairs > most
        if made.large:
            joined = shared.filter("large and not open" if grows else "large").select("key")
            pairs.append(by_join(rows.join(joined, "key", "left_semi")))
        if made.rows:
            small = shared.filter("not large").select(
                "key", "state", (F.col("open") & (F.col("pairs") > pairs_per_key)).alias("grows")
            )
            pairs.append(by_task(rows, small, cuts, made.rows))
        if not grows:
            return pairs, many
        growing = shared.filter("large and open")
        table = cuts.table(cuts.steps_of(growing), f"of int, {STEP}").drop("lead", "head")
        rows = (
            rows.join(growing.select("key"), "key", "left_semi")
            .withColumnRenamed("state", "of")
            .drop("open")
            .join(table, "of")
            .withColumn("key", _signature(F.col("key")))
            .select(*columns)
        )
        number += 1


def by_task(rows: DataFrame, keys: DataFrame, cuts: Cuts, count: int) -> DataFrame:
    """Candidate pairs under ``keys``. Their rows are dealt to tasks once; where a key ``grows``,
    they meet there under signatures longer by a segment."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // TASK_ROWS))
    dealt = rows.repartition(parts, "key").join(
        keys.select("key", "grows").repartition(parts, "key"), "key"
    )
    stays = -1
    table = cuts.table(
        [(stays, 0, 1, 0, stays, False, 1, 0), *cuts.steps_of(keys.filter("grows"))],
        f"of int, {STEP.replace('head', 'lead_size')}",
    )
    of = F.when(F.col("grows") & F.col("open"), F.col("state")).otherwise(stays)
    deep = (
        dealt.withColumn("of", of)
        .select("key", "is_left", "text", "marks", "head", "of")
        .join(table, "of")
        .withColumn(
            "deep", F.when(F.col("of") == stays, F.col("key")).otherwise(_signature(F.col("key")))
        )
    )
    lead = F.when(F.col("lead_size") > 0, F.substring("text", F.col("lead"), F.col("lead_size")))
    texts = F.struct("text", "marks", lead.alias("lead"))
    # grouped by the key that the rows are dealt by and the longer one: not dealt again
    groups = (
        deep.groupBy("key", "deep")
        .agg(
            F.any_value("head").alias("head"),
            F.collect_list(F.when(F.col("is_left"), texts)).alias("lefts"),
            F.collect_list(F.when(~F.col("is_left"), texts)).alias("rights"),
        )
        .filter((F.size("lefts") > 0) & (F.size("rights") > 0))
    )
    pairs = (
        groups.select("head", F.explode("lefts").alias("l"), "rights")
        .select("head", "l", F.explode("rights").alias("r"))
        .filter(F.col("l.lead").isNull() | (F.col("l.lead") != F.col("r.lead")))
        .select(
            "head",
            F.col("l.text").alias("left_text"),
            F.col("l.marks").alias("left_marks"),
            F.col("r.text").alias("right_text"),
            F.col("r.marks").alias("right_marks"),
        )
    )
    return _first_met(pairs)


def by_join(rows: DataFrame) -> DataFrame:
    """Candidate pairs of rows with equal keys, however many share one."""
    sides = [
        rows.filter(F.col("is_left") if is_left else ~F.col("is_left")).select(
            "key",
            "head",
            F.col("text").alias(f"{side}_text"),
            F.col("marks").alias(f"{side}_marks"),
        )
        for is_left, side in ((True, "left"), (False, "right"))
    ]
    return _first_met(sides[0].join(sides[1].drop("head"), "key").drop("key"))


def _first_met(pairs: DataFrame) -> DataFrame:
    """Without pairs that agree in the first segment but met under another one."""
    begins = [F.substring(F.col(f"{side}_text"), F.lit(1), F.col("head")) for side in ("left", "right")]
    return pairs.filter((F.col("head") == 0) | (begins[0] != begins[1])).drop("head")


def by_one_segment(sides: DataFrame, longer: set[int], cutoff: int) -> DataFrame:
    """Candidate pairs whose longer text has one of the lengths ``longer``: they share one of
    its segments, in reach of where it stands."""
    rows = sorted(
        (n, part, begin + 1, size)
        for n in longer
        for part, (begin, size) in enumerate(segments(n, allowance(n, cutoff)))
    )
    spark = sides.sparkSession
    table = spark.createDataFrame(rows, "length int, part int, begin int, size int")
    sizes = spark.createDataFrame(sorted({(r[3],) for r in rows}), "size int")
    pieces = sides.join(F.broadcast(table), "length").withColumn(
        "piece", F.substring(F.col("text"), F.col("begin"), F.col("size"))
    )
    begins = F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)
    probes = (
        sides.join(F.broadcast(sizes), F.col("size") <= F.col("length"))
        .withColumn("begin", F.explode(begins))
        .withColumn("piece", F.substring(F.col("text"), F.col("begin"), F.col("size")))
    )
    b, a = pieces.alias("b"), probes.alias("a")
    edits = F.floor(F.col("b.length") * F.lit(100 - cutoff) / F.lit(100))
    shorter = (F.col("a.length") < F.col("b.length")) | (
        (F.col("a.length") == F.col("b.length")) & F.col("a.is_left")
    )
    moved = F.abs(F.col("a.begin") - F.col("b.begin"))
    behind = F.abs(
        (F.col("a.length") - F.col("a.begin")) - (F.col("b.length") - F.col("b.begin"))
    )
    pairs = b.join(
        a,
        (F.col("a.piece") == F.col("b.piece"))
        & (F.col("a.is_left") != F.col("b.is_left"))
        & shorter
        & (moved <= F.col("b.part"))
        & (behind <= edits - F.col("b.part")),
    )

    def of(side: str, column: str) -> Column:
        wanted = F.col("b.is_left") if side == "left" else ~F.col("b.is_left")
        return F.when(wanted, F.col(f"b.{column}")).otherwise(F.col(f"a.{column}"))

    return pairs.select(
        of("left", "text").alias("left_text"),
        of("left", "marks").alias("left_marks"),
        of("right", "text").alias("right_text"),
        of("right", "marks").alias("right_marks"),
    )


def candidates(
    left: DataFrame,
    right: DataFrame,
    cutoff: int,
    workspace: Workspace,
    label: str,
    pairs_per_name: int | None = None,
    pairs_per_key: int | None = None,
) -> DataFrame:
    """All pairs of distinct texts that may score ``cutoff`` or more, some more than once:
    ``left_text, left_marks`` and the same of ``right``."""
    per_name = PAIRS_PER_NAME if pairs_per_name is None else pairs_per_name
    per_key = PAIRS_PER_KEY if pairs_per_key is None else pairs_per_key
    sides = workspace.keep(_sides(left, right), f"{label}-sides")
    found, many = signature_pairs(sides, cutoff, workspace, label, per_name, per_key)
    if many:
        found.append(by_one_segment(sides, many, cutoff))
    if found:
        return reduce(DataFrame.unionByName, found)
    marks = "marks struct<low: bigint, high: bigint>"
    columns = [f"{side}_text string, {side}_{marks}" for side in ("left", "right")]
    return left.sparkSession.createDataFrame([], ", ".join(columns))
