r"""Line deduplication within one edit, by deletion neighbourhoods.

Two lines are within the bound if one becomes the other by replacing, inserting or deleting
one word; in scripts written without blanks, one character. Every line emits the hashes of all its variants with one word left out, and lines
that share a variant at the same place (a replacement), or of which one is the other's variant
(an insertion), are compared word by word. A key keeps its earliest line only, so thousands of
lines from one template cost one entry each and no pairs.

Lines that no other could be within the bound of emit nothing: an edit leaves one half of a
line alone, and seven of its eighths, so only lines that share these with another text go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from entiva.llm.common import BLANKS, attach, text_or_empty
from entiva.session import Workspace

LINE = ["k1", "k2"]


def lines_of(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, line_no`` (from 0) and ``line``, the text of the line."""
    rows = documents.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).filter("doc_id is not null")
    return rows.select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    ).select(
        "doc_id",
        "line_no",
        "line",
    )


def single_spaced(line: Column) -> Column:
    """The words of a line joined by one space; most lines are so already."""
    odd = F.contains(line, F.lit("  ")) | line.startswith(" ") | line.endswith(" ")
    for blank in BLANKS.replace(" ", "").replace("\n", ""):
        odd = odd | F.contains(line, F.lit(blank))
    return F.when(odd, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)


def with_units(lines: DataFrame) -> DataFrame:
    """``lines`` with ``words``, the units that edits are counted in, their number ``n`` and
    ``by_character``: whether the single-spaced ``text`` is cut into characters.

    It is where most characters take three bytes, as Chinese, Japanese and Thai ones do, and
    there is less than one blank in twelve characters.
    """
    text = F.col("text")
    by_character = (F.octet_length(text) * 2 > F.length(text) * 5) & (
        F.length(text) > 12 * F.regexp_count(text, F.lit(" ")) + 12
    )
    marked = lines.withColumn("by_character", by_character)
    words = F.when(F.col("by_character"), F.split("text", "")).otherwise(F.split("text", " "))
    return marked.withColumn("words", words).withColumn("n", F.size("words"))


def part_keys(words: Column, n: Column, parts: int) -> Column:
    """Hashes of all but one of ``parts`` parts, for each part, as a line of ``n`` words and as
    one of one word less. Two lines within one edit of each other share one of them."""
    keys = []
    for m in (n, n - 1):
        for part in range(parts):
            ahead = F.floor(m * part / parts).cast("int")
            behind = (m - F.floor(m * (part + 1) / parts)).cast("int")
            before = [F.slice(words, 1, ahead)] if part else []
            after = [F.slice(words, n - behind + 1, behind)] if part < parts - 1 else []
            keys.append(F.xxhash64(F.lit(part), m, *before, *after))
    return F.array(*keys)


def sharing(lines: DataFrame, keys: str) -> DataFrame:
    """The lines that have one of their ``keys`` in common with another line."""
    each = lines.select("line", F.explode(keys).alias("key"))
    shared = each.groupBy("key").agg(F.count("*").alias("lines")).filter("lines > 1")
    return each.join(shared.select("key"), "key", "left_semi").select("line").distinct()


#: A sieve has one to this many buckets of 63 bits, so what is broadcast is bounded.
MOST_BUCKETS = 1 << 20


def sifted(rows: DataFrame, lines: DataFrame, key: tuple[str, ...] = ("line",)) -> DataFrame:
    """The ``rows`` whose ``key`` is among the distinct ones of ``lines``, with the columns of both.

    A sieve of the lines' hashes, eight bits a line up to the bound, leaves out most other rows
    before the exact join; a fuller one leaves out fewer.
    """
    buckets = min(MOST_BUCKETS, 1 << (lines.count() // 8).bit_length())
    place = f"xxhash64({', '.join(key)})"
    bit = f"shiftleft(1L, cast(pmod(shiftright({place}, 24), 63) as int))"
    bucket = F.expr(f"pmod({place}, {buckets})")
    bits = lines.groupBy(bucket.alias("bucket")).agg(F.expr(f"bit_or({bit})").alias("bits"))
    passed = (
        rows.withColumn("bucket", bucket)
        .join(F.broadcast(bits), "bucket")
        .filter(f"bits & {bit} <> 0")
        .drop("bucket", "bits")
    )
    # no semi join: that one would be moved ahead of the sieve
    return passed.join(lines, list(key))


def place_of(rows: DataFrame) -> Column:
    """A line's place in the order by id, then line: one number if ids and lines are small
    enough for that, which sorts and sends less, else both."""
    both = F.struct("doc_id", "line_no")
    if not isinstance(rows.schema["doc_id"].dataType, IntegralType):
        return both
    ends = rows.agg(F.min("doc_id"), F.max("doc_id"), F.max("line_no")).first()
    if ends[0] is None or ends[0] < 0 or ends[1] >= 1 << 40 or ends[2] >= 1 << 22:
        return both
    return F.shiftleft(F.col("doc_id").cast("long"), 22).bitwiseOR(F.col("line_no").cast("long"))


def variants(lines: DataFrame) -> DataFrame:
    """``line, n, at, rest, hash``: each line with the word ``at`` left out, and the whole line
    as one with ``at`` -1. ``rest`` is the number of words hashed.

    The hash adds up words with their places, so running sums give all variants of a line.
    """
    mask = (1 << 40) - 1
    words = lines.select("line", "n", F.posexplode("words").alias("at", "word"))
    here = F.xxhash64("word", "at").bitwiseAND(F.lit(mask))
    moved = F.xxhash64("word", F.col("at") - 1).bitwiseAND(F.lit(mask))
    placed = words.select("line", "n", "at", here.alias("here"), moved.alias("moved"))
    sums = "over (partition by line order by at rows between unbounded preceding and current row)"
    running = placed.selectExpr(
        "line", "n", "at", "here", "moved",
        f"sum(here) {sums} as before", f"sum(moved) {sums} as shifted",
    )
    totals = placed.groupBy("line", "n").agg(
        F.sum("here").alias("whole"), F.sum("moved").alias("all_moved")
    )
    left_out = running.join(totals.select("line", "all_moved"), "line").select(
        "line",
        "n",
        "at",
        (F.col("n") - 1).alias("rest"),
        (F.col("before") - F.col("here") + F.col("all_moved") - F.col("shifted")).alias("hash"),
    )
    whole = totals.select(
        "line", "n", F.lit(-1).alias("at"), F.col("n").alias("rest"), F.col("whole").alias("hash")
    )
    return left_out.unionByName(whole)


def repeated_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_near_words: int = 8,
    least_near_characters: int = 16,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, line_no, near``, one row for each line that an earlier line makes redundant.

    Lines are compared by their words, whatever the white space between them; order is by id,
    then line. A line goes for an equal one, whatever its length, and one of ``least_near_words``
    words or more also for one within one edited word (``near`` true). Lines in a script without
    blanks (see :func:`with_units`) are compared by characters, and need
    ``least_near_characters``; near are only lines of one kind. The earlier line need not
    stay itself. Blank lines stay, so null and empty texts lose none; rows with a null id
    are left alone; of repeated rows with one id, lines count once. An empty table gives no
    rows; other columns are ignored.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    all_lines = lines_of(documents, id_column, text_column)
    least = F.when(F.col("by_character"), least_near_characters).otherwise(least_near_words)
    spaced = all_lines.select("doc_id", "line_no", single_spaced(F.col("line")).alias("text"))
    rows = workspace.keep(
        with_units(spaced.filter("text <> ''")).select(
            "doc_id",
            "line_no",
            F.xxhash64("text").alias("k1"),
            F.xxhash64(F.lit("second"), "text").alias("k2"),
            F.when(F.col("n") >= least - 1, part_keys(F.col("words"), F.col("n"), 2)).alias(
                "halves"
            ),
        ),
        "line_keys",
    )
    place = place_of(rows)
    texts = workspace.keep(
        rows.groupBy(*LINE).agg(
            F.min(place).alias("line"),
            F.count("*").alias("group_size"),
            F.any_value("halves").alias("halves"),
        ),
        "line_texts",
    )
    # First those that share a half with another text, then, of these, seven eighths.
    halved = workspace.keep(sharing(texts.filter("halves is not null"), "halves"), "halved")
    with_place = sifted(all_lines.select(place.alias("line"), F.col("line").alias("text")), halved)
    units = with_units(with_place.select("line", single_spaced(F.col("text")).alias("text")))
    half_words = workspace.keep(
        units.dropDuplicates(["line"]).select(
            "line",
            "n",
            least.alias("least"),
            "words",
            part_keys(F.col("words"), F.col("n"), 8).alias("eighths"),
        ),
        "half_words",
    )
    suspects = workspace.keep(sharing(half_words, "eighths"), "suspects")
    own_words = workspace.keep(
        half_words.drop("eighths").join(suspects, "line", "left_semi"), "suspect_words"
    )
    keys = workspace.keep(variants(own_words), "variants")
    # replacements share a place; an insertion is a line that is another's variant
    same_place = (
        keys.filter("at >= 0")
        .groupBy("rest", "hash", "at")
        .agg(F.min("line").alias("other"), F.count("*").alias("lines"))
        .filter("lines > 1")
        .drop("lines")
    )
    by_hash = (
        keys.groupBy("rest", "hash")
        .agg(
            F.min(F.when(F.col("at") < 0, F.col("line"))).alias("whole"),
            F.min(F.when(F.col("at") >= 0, F.col("line"))).alias("longer"),
        )
        .filter("whole is not null and longer is not null")
    )
    inserted = keys.join(by_hash, ["rest", "hash"]).select(
        "line", F.when(F.col("at") < 0, F.col("longer")).otherwise(F.col("whole")).alias("other")
    )
    replaced = keys.join(same_place, ["rest", "hash", "at"]).select("line", "other")
    candidates = replaced.unionByName(inserted).filter("other < line").distinct()
    one, two = F.col("words"), F.col("other_words")
    matching = F.zip_with(one, two, lambda a, b: a.eqNullSafe(b))
    equal_ahead = F.coalesce(F.array_position(matching, False) - 1, F.lit(0)).cast("int")
    longer = F.when(F.size(one) > F.size(two), one).otherwise(two)
    shorter = F.when(F.size(one) > F.size(two), two).otherwise(one)
    without = F.concat(
        F.slice(longer, 1, equal_ahead), F.slice(longer, equal_ahead + 2, F.size(longer))
    )
    within = F.when(
        F.size(one) == F.size(two), F.size(F.filter(matching, lambda same: ~same)) <= 1
    ).otherwise(without == shorter)
    near = (
        candidates.join(own_words.select("line", "words", "least"), "line")
        .join(
            own_words.select(F.col("line").alias("other"), one.alias("other_words"), "least"),
            ["other", "least"],
        )
        .filter(F.greatest(F.size(one), F.size(two)) >= F.col("least"))
        .filter(within)
        .select("line")
        .distinct()
    )
    judged = workspace.keep(
        texts.join(near.withColumn("near", F.lit(True)), "line", "left").select(
            *LINE, "line", "group_size", F.coalesce("near", F.lit(False)).alias("near")
        ),
        "judged_texts",
    )
    later = place > F.col("line")
    return (
        attach(rows.select("doc_id", "line_no", *LINE), judged, LINE)
        .filter(later | F.col("near"))
        .select("doc_id", "line_no", (~later).alias("near"))
        .distinct()
    )


def without_repeated_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    workspace: Workspace | None = None,
    **parameters: int,
) -> DataFrame:
    """``documents`` with repeated lines taken out of the text; all columns stay.

    See :func:`repeated_lines`. A null text stays null.
    """
    gone = repeated_lines(documents, id_column, text_column, workspace=workspace, **parameters)
    of_id, numbers = "of_id", "gone_lines"
    while {of_id, numbers} & {c.lower() for c in documents.columns}:
        of_id, numbers = of_id + "_", numbers + "_"
    lists = gone.groupBy(F.col("doc_id").alias(of_id)).agg(
        F.collect_set("line_no").alias(numbers)
    )
    kept = F.filter(F.split(text_column, "\n"), lambda _, i: ~F.array_contains(numbers, i))
    text = F.when(F.col(numbers).isNull(), F.col(text_column)).otherwise(F.array_join(kept, "\n"))
    joined = documents.join(lists, documents[id_column] == F.col(of_id), "left")
    return joined.withColumn(text_column, text).select(*documents.columns)


def report(documents: DataFrame, gone: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document: number of lines, of those that go, and which they are."""
    lists = gone.groupBy("doc_id").agg(
        F.count("*").alias("n_dropped"),
        F.count_if("near").alias("n_near"),
        F.array_sort(F.collect_set("line_no")).alias("dropped"),
    )
    counts = documents.select(
        F.col(id_column).alias("doc_id"),
        F.size(F.split(text_or_empty(text_column), "\n")).cast("long").alias("n_lines"),
    )
    return counts.join(lists, "doc_id", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
