r"""Benchmark decontamination by canonical templates.

A text becomes a row of words in which names, numbers and units are typed placeholders.
Windows of template words are hashed and joined with those of the benchmark, so that a
question with other numbers or other names still meets its original. Then the slots are
compared: a re-parameterised question puts one value of its own, of the same kind, wherever the
original repeats a value. A coincidence of frames does not.

An item is read in up to four ways, and found if one of them finds it: with names as
placeholders (``NAMES``), with names as plain lower-case words (``PLAIN``, so that the case of
a copy does not decide), word by word with its values (``RAW``, for items in which some window
is mostly placeholders), and as a whole (``SHORT``, for items of one word less than a window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.llm.common import text_or_empty
from entiva.llm.line_dedup import sifted
from entiva.session import Workspace

#: Marks, from the private use area: a word that is a name; a separator inside a number; then
#: the three placeholders.
MARK, POINT, NAME, NUMBER, UNIT = "\ue000", "\ue004", "\ue001", "\ue002", "\ue003"
NAMES, PLAIN, RAW, SHORT = "names", "plain", "raw", "short"

UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons lb "
    "lbs oz ml l liter liters litre litres gal gallon gallons s sec second seconds min minute "
    "minutes h hr hour hours day days week weeks month months year years percent pct dollar "
    "dollars cent cents euro euros usd eur gbp pound pounds mph kmh kph w kw kwh j kj cal kcal "
    "v a hz khz mhz ghz b kb mb gb tb degree degrees"
).split()


def raw_words(text: Column) -> Column:
    """Words of letters and digits joined by one space, names marked.

    A name is a capitalised word that follows a word or a comma, so does not begin a sentence.
    A number keeps its points and commas, as one word.
    """
    spaced = F.regexp_replace(text, r"[\s\p{Z}]+", " ")
    pointed = F.regexp_replace(spaced, r"(?<=\p{N})[.,](?=\p{N})", POINT)
    marked = F.regexp_replace(pointed, r"(?=\p{Lu}\p{Ll})(?<=[\p{L}\p{N},;] )", MARK)
    return F.trim(F.regexp_replace(marked, rf"[^\p{{L}}\p{{N}}{MARK}{POINT}]+", " "))


def typed(words: Column) -> Column:
    """Lower-case words, names still marked, with placeholders of numbers and units."""
    units = "|".join(UNITS)
    # tried at the start of a word only, so that a long word costs no more than its length
    numbered = F.regexp_replace(words, r"(?<![^ ])[^ \p{N}]*+\p{N}[^ ]*+", NUMBER)
    with_units = F.regexp_replace(
        F.lower(numbered), rf"(?<={NUMBER} ){MARK}?(?:{units})(?= |$)", UNIT
    )
    # most texts have no digit, and finding that out is cheap
    return F.when(words.rlike(r"\p{N}"), with_units).otherwise(F.lower(words))


def template(typed_words: Column) -> Column:
    """One placeholder for every run of marked names."""
    # possessive, so that a long run is a loop and not a call for each of its names
    return F.regexp_replace(typed_words, rf"{MARK}[^ ]++(?: {MARK}[^ ]++)*+", NAME)


def unmarked(words: Column) -> Column:
    return F.replace(words, F.lit(MARK), F.lit(""))


def is_placeholder(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def window_hashes(hashes: Column, size: int, chosen=None) -> Column:
    """Array of one hash per window of ``size`` words; ``chosen(i)`` may say otherwise."""
    at = chosen or (lambda i: _hash_at(hashes, i, size))
    return F.when(
        F.size(hashes) >= size, F.transform(F.sequence(F.lit(0), F.size(hashes) - size), at)
    ).otherwise(F.array().cast("array<bigint>"))


def _hash_at(hashes: Column, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])


def _raw_hash_at(hashes: Column, i: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, i + k) for k in range(size)], F.lit(RAW))


def _literals_at(flags: Column, i: Column, size: int) -> Column:
    return sum((F.get(flags, i + k) for k in range(1, size)), F.get(flags, i))


def _hashed(words: Column) -> Column:
    return F.transform(F.split(words, " "), lambda w: F.xxhash64(w))


def _flags(words: Column) -> Column:
    return F.transform(F.split(words, " "), lambda w: (~is_placeholder(w)).cast("int"))


def sought(texts: DataFrame, window: int, least_literals: int, short: bool) -> DataFrame:
    """``hash`` of every window of the texts by which an item can be found first: that of the
    template if it has enough literal words, else that of the raw words."""
    own = [c for c in texts.columns if c != "text"]
    rows = texts.select(*own, raw_words(F.col("text")).alias("raw"))
    rows = rows.select(*own, "raw", typed(F.col("raw")).alias("typed"))
    rows = rows.select(
        *own,
        F.col("typed").rlike(rf"[{NUMBER}{UNIT}]").alias("valued"),
        F.col("typed").contains(MARK).alias("named"),
        unmarked(F.col("typed")).alias("plain"),
        template(F.col("typed")).alias("names"),
        F.lower(unmarked(F.col("raw"))).alias("raw"),
    )
    rows = rows.select(
        *own,
        "valued",
        _hashed(F.col("plain")).alias("plain"),
        F.when(F.col("valued"), _flags(F.col("plain"))).alias("flags"),
        F.when(F.col("valued") | F.lit(short), _hashed(F.col("raw"))).alias("raw"),
        F.when(F.col("named"), _hashed(F.col("names"))).alias("names"),
        F.when(F.col("named"), _flags(F.col("names"))).alias("name_flags"),
        F.when(
            F.col("named"),
            F.transform(F.split("names", " "), lambda w: (w == NAME).cast("int")),
        ).alias("name_at"),
    )
    plain = F.when(
        F.col("valued"),
        window_hashes(
            F.col("plain"),
            window,
            lambda i: F.when(
                _literals_at(F.col("flags"), i, window) >= least_literals,
                _hash_at(F.col("plain"), i, window),
            ).otherwise(_raw_hash_at(F.col("raw"), i, window)),
        ),
    ).otherwise(window_hashes(F.col("plain"), window))
    names = F.when(
        F.col("names").isNotNull(),
        window_hashes(
            F.col("names"),
            window,
            lambda i: F.when(
                (_literals_at(F.col("name_at"), i, window) > 0)
                & (_literals_at(F.col("name_flags"), i, window) >= least_literals),
                _hash_at(F.col("names"), i, window),
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    parts = [plain, names]
    if short:
        size = window - 1
        parts.append(
            window_hashes(F.col("raw"), size, lambda i: _raw_hash_at(F.col("raw"), i, size))
        )
    return rows.select(*own, F.explode(F.concat(*parts)).alias("hash")).filter("hash is not null")


def readings(rows: DataFrame, window: int) -> DataFrame:
    """Every reading of ``raw``, or those in the column ``wanted``: its words and, of each, the
    value in the text."""
    some = "wanted" in rows.columns
    own = [c for c in rows.columns if c not in ("raw", "wanted")]
    wanted = ["wanted"] if some else []
    # arrays are columns before they are indexed, so that no text is split once per word
    rows = rows.withColumn("typed", typed(F.col("raw"))).select(
        *own,
        *wanted,
        "typed",
        F.split("typed", " ").alias("typed_words"),
        F.split(F.lower(unmarked(F.col("raw"))), " ").alias("values"),
    )
    # of a run of names the first one stands for all, as in the template
    values = F.col("values")
    in_run = lambda i: (i > 0) & F.get("typed_words", i).startswith(MARK) & F.get(
        "typed_words", i - 1
    ).startswith(MARK)
    first = F.filter("values", lambda v, i: ~in_run(i))

    def reading(kind: str, words: Column, own_values: Column) -> Column:
        made = F.struct(
            F.lit(kind).alias("reading"), words.alias("words"), own_values.alias("values")
        )
        return F.when(F.array_contains("wanted", kind), made) if some else made

    return (
        rows.select(
            *own,
            F.inline(
                F.array(
                    reading(
                        NAMES,
                        F.split(template(F.col("typed")), " "),
                        first,
                    ),
                    reading(PLAIN, F.split(unmarked(F.col("typed")), " "), values),
                    reading(RAW, values, values),
                    reading(SHORT, values, values),
                )
            ),
        )
        .filter("reading is not null")
    )


def placed(rows: DataFrame, window: int, valued: bool = False) -> DataFrame:
    """``place``, ``hash`` and number of ``literals`` of every window of ``words``; instead of the
    number the ``values`` of its words if ``valued``, of windows with a placeholder."""
    own = [c for c in rows.columns if c not in ("words", "values")]
    size = F.when(F.col("reading") == SHORT, window - 1).otherwise(window)

    def window_at(i: Column) -> Column:
        part = F.slice("words", i + 1, size)
        slots = F.col("reading").isin(NAMES, PLAIN) & F.exists(part, is_placeholder)
        return F.struct(
            i.alias("place"),
            F.xxhash64(part).alias("hash"),
            F.when(slots, F.slice("values", i + 1, size)).alias("values")
            if valued
            else F.size(F.filter(part, lambda w: ~is_placeholder(w))).alias("literals"),
        )

    return rows.select(
        *own,
        F.inline(
            F.when(
                F.size("words") >= size,
                F.transform(F.sequence(F.lit(0), F.size("words") - size), window_at),
            )
        ),
    )


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 5,
    least_literals: int = 3,
    least_coverage: float = 0.6,
    least_consistency: float = 0.9,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, item_id, coverage, n_slots, changed_slots, consistency``, one row for each
    document that holds a benchmark item.

    ``coverage`` is the share of the item's windows (of ``window`` words, each weighing as much
    as it has words that are no placeholders) found anywhere in the document; by raw words all
    windows weigh the same. A text is looked up by its windows of at least ``least_literals``
    such words, and by the raw words of its other windows. ``consistency`` is the share of the
    item's slots that agree with one assignment of values (1 without slots); a slot is
    looked at where a window found covers it, at that window's own shift. The reading with the
    largest coverage is reported.

    Items with ``window - 1`` words are found by their raw words. Items with fewer words match
    nothing; null and empty texts and rows with a null id neither. Repeated documents give
    repeated pairs only once per id. An empty table on either side gives no rows; other columns
    are ignored. Windows of documents are stored only of texts that can hold an item, and only
    those that an item has, each with its values; the hits and the benchmark's windows are, in
    the shared folder.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    items = workspace.keep(
        benchmark.select(
            F.col(item_column).alias("item_id"),
            raw_words(text_or_empty(item_text_column)).alias("raw"),
        ).filter("item_id is not null"),
        "items",
    )
    # one item stands for all with its words
    distinct = workspace.keep(
        items.groupBy("raw").agg(F.min("item_id").alias("item")), "distinct_items"
    )
    read = readings(distinct.select("item", "raw"), window)
    windows = placed(read, window).withColumnRenamed("place", "item_place")
    about = windows.groupBy("item").agg(
        F.min(F.when(F.col("reading") == PLAIN, F.col("literals"))).alias("least"),
    )
    named = read.filter(F.col("reading") == NAMES).select(
        "item", F.array_contains("words", NAME).alias("named")
    )
    # the hash by which sought() finds the window, null for those not looked up
    plain = windows.filter(F.col("reading") == PLAIN).select(
        "item", "item_place", F.col("literals").alias("plain_literals")
    )
    values = distinct.select("item", _hashed(F.lower(unmarked(F.col("raw")))).alias("v"))
    tokens = read.filter(F.col("reading").isin(NAMES, PLAIN)).select(
        "item", "reading", F.transform("words", lambda w: F.xxhash64(w)).alias("t")
    )
    at = F.col("item_place")
    by_template = _hash_at(F.col("t"), at, window)
    by_values = _raw_hash_at(F.col("v"), at, window)
    enough = F.col("literals") >= least_literals
    of_items = (
        windows.join(about, "item")
        .join(named, "item")
        .join(values, "item")
        .join(tokens, ["item", "reading"], "left")
        .join(plain, ["item", "item_place"], "left")
        .filter(
            ((F.col("reading") == NAMES) & F.col("named"))
            | (F.col("reading") == PLAIN)
            | ((F.col("reading") == RAW) & (F.col("least") < least_literals))
            | ((F.col("reading") == SHORT) & (F.size("v") == window - 1))
        )
        .select(
            "item",
            "reading",
            "item_place",
            "hash",
            F.when(F.col("reading").isin(NAMES, PLAIN), F.col("literals"))
            .otherwise(1)
            .alias("weight"),
            F.when(F.col("reading").isin(NAMES, PLAIN), F.when(enough, by_template))
            .when(
                F.col("reading") == RAW,
                F.when(F.col("plain_literals") < least_literals, by_values),
            )
            .otherwise(_raw_hash_at(F.col("v"), at, window - 1))
            .alias("sought"),
        )
        .filter("weight > 0")
    )
    of_items = workspace.keep(of_items, "item_windows")
    totals = of_items.groupBy("item", "reading").agg(
        F.sum("weight").alias("total"),
        F.sum(F.when(F.col("sought").isNull(), F.col("weight")).otherwise(0)).alias("free"),
    )
    short = not of_items.filter(F.col("reading") == SHORT).isEmpty()
    texts = documents.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text")
    ).filter("doc_id is not null")
    # texts that share an id are looked at each by itself
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    key = ["doc_id", "text_key", "item", "reading"]
    first_hits = workspace.keep(
        sought(texts, window, least_literals, short).join(
            of_items.filter("sought is not null").select(
                "item", "reading", "item_place", "weight", F.col("sought").alias("hash")
            ),
            "hash",
        ),
        "first_hits",
    )
    # what can still reach the coverage if all windows not looked up are found
    possible = workspace.keep(
        first_hits.groupBy(*key, "item_place")
        .agg(F.first("weight").alias("weight"))
        .groupBy(*key)
        .agg(F.sum("weight").alias("got"))
        .join(totals, ["item", "reading"])
        .filter(F.col("got") + F.col("free") >= least_coverage * F.col("total") - 1e-9)
        .select(*key, "total"),
        "possible",
    )
    # a text's words are taken one text at a time and never stored: read again, they would be
    # arrays of whole texts, thousands of them in one batch of the reader
    text = ("doc_id", "text_key")
    wanted = workspace.keep(
        possible.groupBy(*text).agg(F.collect_set("reading").alias("wanted")), "wanted"
    )
    # the sieve leaves out most texts, so that these are not dealt out where many are wanted
    own = (
        sifted(texts, wanted, text)
        .dropDuplicates([*text])
        .select(*text, "wanted", raw_words(F.col("text")).alias("raw"))
    )
    # of their windows only those of some item are dealt out
    own_windows = placed(readings(own, window), window, valued=True).join(
        of_items.select("reading", "hash"), ["reading", "hash"], "left_semi"
    )
    hits = workspace.keep(
        possible.join(of_items.drop("sought"), ["item", "reading"])
        .join(own_windows, ["doc_id", "text_key", "reading", "hash"])
        .select(*key, "total", "item_place", "place", "weight", "values"),
        "window_hits",
    )
    found = (
        hits.groupBy(*key, "total", "item_place")
        .agg(F.first("weight").alias("weight"))
        .groupBy(*key, "total")
        .agg(F.sum("weight").alias("got"))
        .withColumn("coverage", F.col("got") / F.col("total"))
        .filter(F.col("coverage") >= least_coverage)
        .select(*key, "coverage")
    )
    found = workspace.keep(found, "covered")

    # slots: what stands in the document where the item has a placeholder
    slots = (
        read.filter(F.col("reading").isin(NAMES, PLAIN))
        .select("item", "reading", F.posexplode(F.arrays_zip("words", "values")).alias("at", "pair"))
        .select(
            "item",
            "reading",
            "at",
            F.col("pair.words").alias("word"),
            F.col("pair.values").alias("value"),
        )
        .filter(is_placeholder(F.col("word")))
    )
    # windows found side by side, an edit between them or not, belong to one copy of the item
    nearby = Window.partitionBy(*key).orderBy("shift").rangeBetween(-window, window)
    shifts = (
        hits.join(found.select(*key), key, "left_semi")
        .groupBy(*key, (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.count("*").alias("n"), F.collect_set("item_place").alias("covered"))
        .withColumn("copy", F.sum("n").over(nearby))
    )
    covering = F.array_min(
        F.filter("covered", lambda p: (p <= F.col("at")) & (F.col("at") < p + window))
    )
    # a window found has the item's words, so a value of the same kind stands in each slot of it
    seen = (
        shifts.join(slots, ["item", "reading"])
        .withColumn("item_place", covering)
        .filter("item_place is not null")
        .groupBy(*key, "at", "word", "value")
        .agg(
            F.max_by(
                F.struct("item_place", (F.col("item_place") + F.col("shift")).alias("place")),
                F.struct("copy", "n", -F.col("shift")),
            ).alias("by")
        )
        .select(*key, "at", "word", "value", "by.*")
        .join(
            hits.select(*key, "item_place", "place", "values"), [*key, "item_place", "place"]
        )
        .select(
            *key,
            "word",
            "value",
            F.get("values", F.col("at") - F.col("item_place")).alias("own_value"),
        )
    )
    by_value = (
        seen.groupBy(*key, "word", "value", "own_value")
        .agg(F.count("*").alias("n"))
        .groupBy(*key, "word", "value")
        .agg(
            F.sum("n").alias("n"),
            F.max("n").alias("agreed"),
            F.min(F.col("own_value") == F.col("value")).alias("unchanged"),
        )
        .groupBy(*key)
        .agg(
            F.sum("n").alias("n_slots"),
            F.sum("agreed").alias("agreed"),
            F.sum(F.when(F.col("unchanged"), 0).otherwise(F.col("n"))).alias("changed_slots"),
        )
    )
    order = F.struct(
        "coverage", F.coalesce("n_slots", F.lit(0)), F.col("reading"), F.col("text_key")
    )
    judged = (
        found.join(by_value, key, "left")
        .withColumn("consistency", F.coalesce(F.col("agreed") / F.col("n_slots"), F.lit(1.0)))
        .filter(F.col("consistency") >= least_consistency)
        .groupBy("doc_id", "item")
        .agg(
            F.max_by(
                F.struct(
                    "coverage",
                    F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
                    F.coalesce("changed_slots", F.lit(0)).cast("long").alias("changed_slots"),
                    "consistency",
                ),
                order,
            ).alias("best")
        )
        .select("doc_id", "item", "best.*")
    )
    alike = items.join(distinct, "raw").select("item_id", "item")
    return (
        judged.join(alike, "item")
        .select(
            "doc_id", "item_id", "coverage", "n_slots", "changed_slots", "consistency"
        )
        .distinct()
    )
