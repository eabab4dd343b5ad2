"""URL filters by a Bloom filter cascade.

A list holds keys: a host, or a host and the start of a path. A key fits its host and all
subdomains. Every URL has one possible key per shape (number of host labels, length of path)
that occurs on a list, so the keys of all URLs are a known, finite universe, and a cascade can
be built that makes no error on it: level 1 encodes the listed keys, level 2 the other keys of
the universe that pass level 1 by chance, level 3 the listed keys that pass level 2, and so on
until no key passes by chance. The first level that a key does not pass tells whether it is
listed. The universe is gathered by one aggregation; URLs are then judged in place, without a
join, by tasks that hold the cascade.

The universe is dealt into shards by hash and every shard has a cascade of its own, built in
one task from a bounded number of keys. Shards travel in parts of bounded size; a list whose
cascade is larger takes several passes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import lower_ascii, ship, text_or_empty
from entiva.session import Workspace

#: What a list says about its keys, as bits, so that a key can be on several lists.
ALLOW, BLOCK, UNWANTED = 1, 2, 4
LISTS = (ALLOW, BLOCK, UNWANTED)

#: Keys of the universe that one task turns into a cascade, about.
KEYS_PER_SHARD = 262_144
#: Most bytes of cascades that are sent to the tasks at once.
PART_BYTES = 64 << 20
#: More levels than chance can bring about.
MOST_LEVELS = 96


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = text_or_empty(url)
    return (
        lower_ascii(F.regexp_extract(text, pattern, 1)),
        F.regexp_extract(text, pattern, 2),
    )


def domains_with(urls: DataFrame, url_column: str, words: list[str]) -> DataFrame:
    """The domains ``key``, each once, whose first label has one of ``words`` between hyphens,
    of all hosts that are in or below one; the last label of a host is not looked at."""
    host, _ = url_parts(F.col(url_column))
    pattern = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\..+)$"
    return (
        urls.select(F.regexp_extract(host, pattern, 1).alias("key"))
        .filter(F.col("key") != "")
        .distinct()
    )


def as_list(keys: DataFrame, action: int) -> DataFrame:
    """One row ``key, lists`` per key; null and empty keys and keys without a host are left out."""
    host = F.substring_index("key", "/", 1)
    path = F.expr("substring(key, length(substring_index(key, '/', 1)) + 1)")
    return (
        keys.filter(host != "")
        .select(F.concat(lower_ascii(host), path).alias("key"), F.lit(action).alias("lists"))
    )


def _host_dots(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))


def shapes_of(lists: DataFrame) -> list[tuple[int, int]]:
    """The (labels, path length) of the listed keys: a few numbers, however long the list."""
    host = F.substring_index("key", "/", 1)
    shape = F.struct(
        (_host_dots(host) + 1).alias("labels"), (F.length("key") - F.length(host)).alias("path")
    )
    found = lists.select(shape.alias("shape")).distinct().select("shape.*")
    return sorted((r.labels, r.path) for r in found.collect())


def keys_of(shapes: list[tuple[int, int]]) -> Column:
    """The possible keys of a URL with columns ``host, path, dots, path_chars``."""
    keys = [
        F.when(
            (F.col("host") != "")
            & (F.col("dots") >= labels - 1)
            & (F.col("path_chars") >= length),
            F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length)),
        )
        for labels, length in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _first_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _second_hash(key: Column) -> Column:
    """Starts from another seed, so it is not a function of the first."""
    return F.xxhash64(F.lit("second"), key)


def _mixed(first: np.ndarray, second: np.ndarray, number: int) -> np.ndarray:
    """The hash of this number: all of them differ between levels and between functions."""
    values = first + second * np.uint64(2 * number + 1)
    values ^= values >> np.uint64(31)
    values *= np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


#: Hash functions that a level may have at most, so that numbers do not repeat.
MOST_FUNCTIONS = 32


def _places(
    first: np.ndarray, second: np.ndarray, level: int, function: int, bits: np.ndarray | int
) -> np.ndarray:
    return _mixed(first, second, level * MOST_FUNCTIONS + function) % np.uint64(bits)


@dataclass
class Level:
    """One Bloom filter: its bits, packed, and its number of hash functions."""

    bits: int
    functions: int
    data: np.ndarray

    @classmethod
    def of(cls, first: np.ndarray, second: np.ndarray, level: int, chance: float) -> Level:
        """Encodes the keys so that another passes with about this chance."""
        functions = min(MOST_FUNCTIONS, max(1, round(-np.log2(chance))))
        bits = max(64, int(len(first) * -np.log2(chance) / np.log(2)) + 1)
        marks = np.zeros(bits, np.uint8)
        for function in range(functions):
            marks[_places(first, second, level, function, bits)] = 1
        return cls(bits, functions, np.packbits(marks, bitorder="little"))

    def passes(self, first: np.ndarray, second: np.ndarray, level: int) -> np.ndarray:
        passed = np.ones(len(first), bool)
        for function in range(self.functions):
            place = _places(first, second, level, function, self.bits)
            passed &= (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)) & 1).astype(bool)
        return passed


def build_levels(listed: np.ndarray, others: np.ndarray) -> list[Level]:
    """The cascade of two disjoint key sets, each an array of two hashes per key."""
    levels: list[Level] = []
    encoded, tested = listed, others
    while len(encoded):
        if len(levels) == MOST_LEVELS:
            raise ValueError("two keys of the universe have the same hashes")
        # the first level halves what the second has to hold, the others halve what is left
        chance = 0.5
        if not levels and len(tested):
            chance = min(0.5, 0.7 * len(encoded) / len(tested))
        number = len(levels)
        level = Level.of(encoded[:, 0], encoded[:, 1], number, chance)
        levels.append(level)
        passed = tested[level.passes(tested[:, 0], tested[:, 1], number)]
        encoded, tested = passed, encoded
    return levels


@dataclass
class Part:
    """The cascades of the shards from ``begin`` up to ``end``, by list and by level."""

    shards: int
    begin: int
    end: int
    cascades: dict[int, dict[int, list[Level]]] = field(default_factory=dict)

    def arranged(self) -> dict[int, list[tuple[np.ndarray, ...]]]:
        """Per list and level the shards' bits end to end, with each shard's first byte, number
        of bits and number of functions; a shard without the level has no bits."""
        arranged: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for action, by_shard in self.cascades.items():
            depth = max(map(len, by_shard.values()), default=0)
            for number in range(depth):
                start = np.zeros(self.end - self.begin, np.int64)
                bits = np.zeros(self.end - self.begin, np.uint64)
                functions = np.zeros(self.end - self.begin, np.int64)
                pieces, size = [], 0
                for shard, levels in by_shard.items():
                    if number < len(levels):
                        place, level = shard - self.begin, levels[number]
                        start[place], bits[place] = size, level.bits
                        functions[place] = level.functions
                        pieces.append(level.data)
                        size += len(level.data)
                arranged.setdefault(action, []).append(
                    (start, bits, functions, np.concatenate(pieces))
                )
        return arranged


def listed_in(
    arranged: list[tuple[np.ndarray, ...]], shard: np.ndarray, first: np.ndarray, second: np.ndarray
) -> np.ndarray:
    """Whether each key is listed. ``shard`` counts from the start of the part."""
    answer = np.zeros(len(shard), bool)
    open_ = np.arange(len(shard))
    for number, (start, bits, functions, data) in enumerate(arranged):
        # a shard whose cascade ends here has no key that passed its last level by chance:
        # what is still open passed it rightly
        open_ = open_[bits[shard[open_]] > 0]
        own = shard[open_]
        passed = np.ones(len(open_), bool)
        for function in range(int(functions.max(initial=0))):
            used = function < functions[own]
            place = _places(first[open_], second[open_], number, function, bits[own])
            byte = data[start[own] + (place >> np.uint64(3)).astype(np.int64)]
            passed &= ~used | (byte >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        open_ = open_[passed]
        # passing an odd number of levels means listed, an even number not listed
        answer[open_] = number % 2 == 0
    return answer


@dataclass
class Cascade:
    """A built cascade: a table of shards, and the shapes of its keys."""

    table: DataFrame
    shapes: list[tuple[int, int]]
    shards: int
    part_bytes: int

    def parts(self) -> Iterator[Part]:
        """The shards in parts of at most ``part_bytes`` (one shard at least)."""
        sizes = self.table.groupBy("shard").agg(F.sum(F.length("levels")).alias("size"))
        total = self.table.agg(F.sum(F.length("levels"))).first()[0] or 0
        largest = sizes.agg(F.max("size")).first()[0] or 0
        if not total:
            return
        step = self.shards
        if total > self.part_bytes:
            step = max(1, self.part_bytes // largest)
        for begin in range(0, self.shards, step):
            part = Part(self.shards, begin, min(self.shards, begin + step))
            own = self.table.filter(F.col("shard").between(part.begin, part.end - 1))
            for row in own.collect():
                part.cascades.setdefault(row.list, {})[row.shard] = pickle.loads(row.levels)
            yield part


def build(
    urls: DataFrame,
    lists: DataFrame,
    workspace: Workspace,
    url_column: str = "url",
    keys_per_shard: int = KEYS_PER_SHARD,
    part_bytes: int = PART_BYTES,
) -> Cascade:
    """The cascade of ``lists`` (rows of ``as_list``) over the keys of all ``urls``.

    Listed keys belong to the universe whether or not a URL has them.
    """
    ship(urls.sparkSession)
    lists = workspace.keep(lists, "url-lists")
    shapes = shapes_of(lists)
    keys = with_keys(urls, url_column, shapes).select(
        F.explode("keys").alias("key"), F.lit(0).alias("lists")
    )
    universe = workspace.keep(
        keys.unionAll(lists.select("key", "lists"))
        .groupBy("key")
        .agg(F.bit_or("lists").alias("lists"))
        .select(
            _first_hash(F.col("key")).alias("first"),
            _second_hash(F.col("key")).alias("second"),
            "lists",
        ),
        "url-universe",
    )
    shards = max(1, -(-universe.count() // keys_per_shard))

    def shard_levels(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows[["first", "second"]].to_numpy().astype(np.int64).view(np.uint64)
        if len(np.unique(keys, axis=0)) < len(keys):
            raise ValueError("two keys of the universe have the same hashes")
        on, found = rows["lists"].to_numpy(), []
        for action in LISTS:
            levels = build_levels(keys[on & action > 0], keys[on & action == 0])
            if levels:
                found.append((int(rows["shard"].iloc[0]), action, pickle.dumps(levels)))
        return pd.DataFrame(found, columns=["shard", "list", "levels"])

    table = workspace.keep(
        universe.withColumn("shard", F.pmod("first", F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(shard_levels, "shard int, list int, levels binary"),
        "url-cascade",
    )
    return Cascade(table, shapes, shards, part_bytes)


def with_keys(urls: DataFrame, url_column: str, shapes: list[tuple[int, int]]) -> DataFrame:
    """All columns of ``urls``, its ``host`` and ``path`` and the possible ``keys``."""
    host, path = url_parts(F.col(url_column))
    return (
        urls.withColumns({"host": host, "path": path})
        .withColumns({"dots": _host_dots(F.col("host")), "path_chars": F.length("path")})
        .withColumn("keys", keys_of(shapes))
        .drop("dots", "path_chars")
    )


def probe(rows: DataFrame, part: Part) -> DataFrame:
    """``rows`` with the lists of each key, as far as this part knows, added to ``on``."""
    sent = rows.sparkSession.sparkContext.broadcast(part)
    place = {name: i for i, name in enumerate(rows.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = sent.value
        arranged = part.arranged()
        for batch in batches:
            columns = batch.columns
            before = columns[place["on"]]
            first = columns[place["first"]].flatten().to_numpy(zero_copy_only=False)
            second = columns[place["second"]].flatten().to_numpy(zero_copy_only=False)
            on = before.flatten().to_numpy(zero_copy_only=False).copy()
            shard = np.mod(first.astype(np.int64), part.shards)
            own = np.flatnonzero((shard >= part.begin) & (shard < part.end))
            first, second = (h.astype(np.int64).view(np.uint64)[own] for h in (first, second))
            for action, levels in arranged.items():
                found = listed_in(levels, shard[own] - part.begin, first, second)
                on[own[found]] |= action
            offsets = np.concatenate([[0], np.cumsum(before.value_lengths().to_numpy())])
            columns[place["on"]] = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(on, pa.int32())
            )
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    unwanted: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    workspace: Workspace | None = None,
    keys_per_shard: int = KEYS_PER_SHARD,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every row.

    ``rules`` has columns ``key`` and ``verdict`` (allow or block), ``unwanted`` a column
    ``key``. ``rule`` is the longest rule that fits, and gives the verdict; a key that is both
    allowed and blocked blocks. Where no rule fits, a URL is blocked if a key of ``unwanted``
    fits (``listed``), else allowed. A null URL and one without ``://`` have an empty host,
    which nothing fits. Rows are judged one by one: repeated rows and ids get the same verdict,
    an empty table gives no rows, and other columns are ignored. Empty lists allow all.
    """
    workspace = workspace or Workspace(pages.sparkSession)
    lists = (
        as_list(rules.filter("verdict = 'allow'"), ALLOW)
        .unionAll(as_list(rules.filter("verdict = 'block'"), BLOCK))
        .unionAll(as_list(unwanted, UNWANTED))
    )
    urls = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    cascade = build(urls, lists, workspace, "url", keys_per_shard, part_bytes)
    rows = with_keys(urls, "url", cascade.shapes).select(
        "page_id",
        "host",
        "path",
        "keys",
        F.transform("keys", _first_hash).alias("first"),
        F.transform("keys", _second_hash).alias("second"),
        F.transform("keys", lambda key: F.lit(0)).alias("on"),
    )
    for number, part in enumerate(cascade.parts()):
        rows = probe(workspace.keep(rows, f"url-judged-{number}") if number else rows, part)
    fits = F.filter(
        F.arrays_zip("keys", "on"), lambda k: k["on"].bitwiseAND(F.lit(ALLOW | BLOCK)) > 0
    )
    # all fitting keys end one host and begin one path, so two of one length can differ
    # only in where the path begins; the later host wins, by order of the key
    longest = F.array_max(
        F.transform(
            fits,
            lambda k: F.struct(
                F.length(k["keys"]).alias("n"), k["keys"].alias("key"), k["on"].alias("on")
            ),
        )
    )
    listed = F.exists("on", lambda on: on.bitwiseAND(F.lit(UNWANTED)) > 0)
    blocked = F.when(
        F.col("best").isNotNull(), F.col("best.on").bitwiseAND(F.lit(BLOCK)) > 0
    ).otherwise(F.col("listed"))
    return rows.withColumns({"best": longest, "listed": listed}).select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        "listed",
    )
