"""Near-duplicate detection by circulant MinHash, banding and exact verification.

Two permutations make a whole signature: the first scatters the shingles of a document, the
second, circularly shifted by 0, 1, 2 ... places, ranks them; coordinate *k* is the least rank
under shift *k*. Documents that agree in all rows of a band are candidates; each candidate
pair is confirmed on its full shingle sets.

No group is expanded into all its pairs. Documents with equal shingle sets are one node.
In a band's bucket each node first meets a few leaders only. Once these links have been
joined to components, a bucket is looked at again only if it holds several: in a few rounds,
what is outside its largest component meets other members of that. At the end all pairs
across components are compared that counts of common shingles do not rule out, so no link
that joins two components is lost, and thousands of copies cost about as many pairs as rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import attach, ship, slices, small_batches
from entiva.llm.components import components
from entiva.llm.words import hashed_words, in_blocks, mix
from entiva.session import Workspace

#: At similarity 0.75 a pair misses all of 36 bands of 5 rows once in 17,000 times.
BANDS = 36
ROWS = 5

#: Bytes of text whose words are shingled together; what a worker holds is many times that.
SHINGLED_BYTES = 1 << 18

#: Classes by which shingles are counted to rule out pairs.
CLASSES = 64

_SHINGLE = [np.uint64(v) for v in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.

    A text with fewer words than ``size`` is one shingle, one without words has none.
    """
    base, step, short = _SHINGLE
    for _, block in in_blocks(texts, SHINGLED_BYTES):
        words, bounds = hashed_words(block)
        count = max(0, len(words) - size + 1)
        rolled = np.zeros(count, np.uint64)
        for k in range(size):
            rolled *= base
            rolled += words[k : k + count]
        rolled = mix(rolled + step)
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - begin >= size:
                yield np.unique(rolled[begin : end - size + 1])
            elif end > begin:
                value = np.uint64(end - begin)
                with np.errstate(over="ignore"):
                    for word in words[begin:end]:
                        value = value * base + word
                    value = value * short
                yield mix(np.array([value], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Least ranks of the shingles under ``coordinates`` circular shifts."""
    scattered = (mix(shingles) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(scattered), 1024):
        ranks = scattered[None, start : start + 1024] + shifts  # circular: modulo 2**32
        scratch = ranks >> np.uint32(16)
        ranks ^= scratch
        ranks *= np.uint32(0x7FEB352D)
        np.right_shift(ranks, np.uint32(15), out=scratch)
        ranks ^= scratch
        ranks *= np.uint32(0x846CA68B)
        np.right_shift(ranks, np.uint32(16), out=scratch)
        ranks ^= scratch
        np.minimum(least, ranks.min(1), out=least)
    return least


def band_keys(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = signature(shingles, bands * rows).reshape(bands, rows).astype(np.uint64)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * _SHINGLE[0] + values[:, r])
    return keys.view(np.int64)


def signed_sets(
    documents: DataFrame, id_column: str, text_column: str, size: int, bands: int, rows: int
) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` of every row; no key without words."""
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, keys, found = [], [], []
            for shingles in shingle_sets(batch.column(1).to_pylist(), size):
                counts.append(len(shingles))
                some = len(shingles) > 0
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16)
                keys.append(digest.digest() if some else None)
                found.append(band_keys(shingles, bands, rows) if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return documents.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(run, f"doc_id {kind}, n_shingles long, set_key binary, bands array<bigint>")


def compared(
    pairs: DataFrame, documents: DataFrame, id_column: str, text_column: str, size: int
) -> DataFrame:
    """The pairs ``a, b`` with the sizes of their shingle sets' intersection and union."""
    texts = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kind = documents.schema[id_column].dataType.simpleString()
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            commons, unions = [], []
            left = shingle_sets(batch.column(2).to_pylist(), size)
            right = shingle_sets(batch.column(3).to_pylist(), size)
            for x, y in zip(left, right, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                commons.append(common)
                unions.append(len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(commons, pa.int64()),
                    pa.array(unions, pa.int64()),
                ],
                names=["a", "b", "common", "either"],
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(
        run, f"a {kind}, b {kind}, common long, either long"
    )


def shingle_rows(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """``node, component, shingle`` for each shingle of the texts of ``node, component, text``."""
    ids = batch.select([0, 1])  # the text is not repeated with them
    for i, one in enumerate(shingle_sets(batch.column(2).to_pylist(), size)):
        same = ids.slice(i, 1).take(pa.array(np.zeros(len(one), np.int32)))
        yield pa.RecordBatch.from_arrays(
            [same.column(0), same.column(1), pa.array(one.view(np.int64))],
            names=["node", "component", "shingle"],
        )


def loose_shingles(
    nodes: DataFrame, documents: DataFrame, id_column: str, text_column: str, size: int
) -> DataFrame:
    """``node, component, shingle``, one row for each shingle of the nodes' sets."""
    texts = documents.select(
        F.col(id_column).alias("node"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield from shingle_rows(batch, size)

    return (
        nodes.join(texts, "node")
        .select("node", "component", "text")
        .mapInArrow(run, f"node {kind}, component {kind}, shingle long")
    )


def near_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    least_percent: int = 75,
    bands: int = BANDS,
    rows: int = ROWS,
    leaders: int = 3,
    rounds: int = 2,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Rows are linked if their shingle sets have a Jaccard similarity of ``least_percent`` or
    more; ``component_id`` is the smallest id that can be reached by links. Null and empty
    texts have no shingles and stand alone. Rows with a null id take the component of their
    equals, else null; ``kept`` compares null-safely. Repeated rows are equals. Empty tables
    give no rows. Sets, links and components are written to the shared folder.
    """
    ship(documents.sparkSession)
    workspace = workspace or Workspace(documents.sparkSession)
    spark = documents.sparkSession
    with small_batches(spark):
        sets = workspace.keep(
            signed_sets(documents, id_column, text_column, shingle_words, bands, rows), "sets"
        )
    groups = workspace.keep(
        sets.filter("set_key is not null")
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("node"),
            F.count("*").alias("group_size"),
            F.any_value("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
        ),
        "set_groups",
    )
    buckets = groups.filter("node is not null").select(
        F.explode("bands").alias("key"), "node", "n"
    )
    member = F.struct("node", "n")
    shared = workspace.keep(
        buckets.groupBy("key")
        .agg(
            F.count("*").alias("members"),
            F.array(
                *[F.min_by(member, F.xxhash64("node", F.lit(k))) for k in range(leaders)]
            ).alias("leaders"),
        )
        .filter("members > 1"),
        "shared_buckets",
    )
    # of the buckets' rows only those that share theirs are needed again
    met = workspace.keep(buckets.join(shared, "key"), "met")
    close = f"100 * least(n, m) >= {least_percent} * greatest(n, m)"
    check = (documents, id_column, text_column, shingle_words)
    similar = f"100 * common >= {least_percent} * either"

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        with small_batches(spark):
            return workspace.keep(compared(pairs, *check), label)

    def pairs_of(rows: DataFrame) -> DataFrame:
        """Distinct pairs of ``node`` and ``other`` that sizes alone do not rule out."""
        return (
            rows.filter(F.col("node") != F.col("other"))
            .filter(close)
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct()
        )

    first = pairs_of(
        met.select("node", "n", F.explode(F.array_distinct("leaders")).alias("leader")).select(
            "node", "n", F.col("leader.node").alias("other"), F.col("leader.n").alias("m")
        )
    )
    known = verified(first, "compared_0")
    done = known.select("a", "b")
    labels = workspace.keep(components(known.filter(similar), workspace, "0"), "labels_0")

    def relabel(new: DataFrame, turn: str) -> DataFrame:
        """Components once more: new links join the names of old ones, and what had these
        names takes the new ones."""
        named = new
        for end in ("a", "b"):
            names = labels.toDF(end, f"of_{end}")
            named = named.join(names, end, "left").withColumn(end, F.coalesce(f"of_{end}", end))
        merged = components(named.select("a", "b"), workspace, turn)
        moved = labels.join(merged.toDF("component", "into"), "component", "left").select(
            "node", F.coalesce("into", "component").alias("component")
        )
        return workspace.keep(moved.unionByName(merged), f"labels_{turn}")

    def open_buckets(turn: int) -> DataFrame:
        """The rows of buckets that hold several components."""
        of_node = met.select("key", "node", "n", "leaders").join(labels, "node", "left")
        of_node = of_node.withColumn("component", F.coalesce("component", "node"))
        mixed = (
            of_node.groupBy("key")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low <> high")
            .select("key")
        )
        return workspace.keep(of_node.join(mixed, "key"), f"open_{turn}")

    rows_left = open_buckets(0)
    for turn in range(1, rounds + 1):
        # other members of a bucket's largest component, each time others
        seeds = [F.lit(turn * leaders + k) for k in range(leaders)]
        largest = (
            rows_left.groupBy("key", "component")
            .agg(
                F.count("*").alias("members"),
                F.array(*[F.min_by(member, F.xxhash64("node", "key", k)) for k in seeds]).alias("of"),
            )
            .groupBy("key")
            .agg(
                F.max_by("of", F.struct("members", "component")).alias("of"),
                F.max_by("component", F.struct("members", "component")).alias("main"),
            )
        )
        tried = pairs_of(
            rows_left.join(largest, "key")
            .filter("component <> main")
            .select("node", "n", F.explode(F.array_distinct("of")).alias("leader"))
            .select(
                "node", "n", F.col("leader.node").alias("other"), F.col("leader.n").alias("m")
            )
        ).join(done, ["a", "b"], "left_anti")
        found = verified(tried, f"compared_{turn}")
        done = done.unionByName(found.select("a", "b"))
        new = found.filter(similar)
        if new.isEmpty():
            break
        labels = relabel(new, str(turn))
        rows_left = open_buckets(turn)

    # What is left are pairs across components. Their common shingles are among those that
    # occur in several components; their counts by class bound the similarity of a pair.
    with small_batches(spark):
        loose = workspace.keep(
            loose_shingles(rows_left.select("node", "component").distinct(), *check), "loose"
        )
    spread = (
        loose.groupBy("shingle")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("shingle")
    )
    class_of = F.pmod("shingle", F.lit(CLASSES))
    in_others = (
        loose.join(spread, "shingle")
        .groupBy("node")
        .agg(
            F.count("*").alias("c"),
            *[F.count_if(class_of == k).cast("int").alias(f"c{k}") for k in range(CLASSES)],
        )
    )
    rows_left = rows_left.drop("leaders").join(in_others, "node")
    rows_left = workspace.keep(rows_left.filter(f"100 * c >= {least_percent} * n"), "open_last")
    other = rows_left.select(
        "key",
        F.col("node").alias("other"),
        F.col("n").alias("m"),
        F.col("component").alias("component_b"),
        *[F.col(f"c{k}").alias(f"e{k}") for k in range(CLASSES)],
    )
    common = " + ".join(f"least(c{k}, e{k})" for k in range(CLASSES))
    percent = 100 + least_percent
    crossing = rows_left.join(other, "key").filter(
        f"node < other and component <> component_b"
        f" and {percent} * ({common}) >= {least_percent} * (n + m)"
    )
    last = pairs_of(crossing).join(done, ["a", "b"], "left_anti")
    new = verified(last, "compared_last").filter(similar)
    if not new.isEmpty():
        labels = relabel(new, "last")
    labelled = groups.join(labels, "node", "left").select(
        "set_key", "group_size", F.coalesce("component", "node").alias("component_id")
    )
    with_words = attach(
        sets.select("doc_id", "n_shingles", "set_key"),
        workspace.keep(labelled, "labelled_sets"),
        ["set_key"],
    )
    alone = sets.filter("set_key is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return (
        with_words.select("doc_id", "n_shingles", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
