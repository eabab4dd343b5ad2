"""Language-model scores from an Elias-Fano n-gram trie.

The trie has a level for each length. A node of level *k* is a pair (context, word): the
number of its context in the level above and the number of its word, joined to one key that
grows with the context. The keys of a level are stored in Elias-Fano form with quantised
log-probabilities, in files under the shared folder that workers map into memory; looking a
word up is a search for the successor of its key within the context.

Levels are counted one after the other over all training documents: tasks send sorted,
compressed runs with one entry per n-gram, dealt out by a hash of the n-gram, so a frequent
context or word is spread like all others. Each shard of a level is one file. Smoothing
interpolates with the shorter context: p(w|h) = (c(hw) + k p(w|h')) / (c(h) + k).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import ship
from entiva.llm.elias_fano import EliasFano, write
from entiva.llm.words import hashed_words, in_blocks, mix
from entiva.session import Workspace

END = np.uint64(0x9AE16A3B2F90404F)
ADDED = 0.1

#: Steps of a stored log10 probability, and the first count that is stored by its logarithm.
STEPS = 4096
EXACT = 1 << 15

#: N-grams of one run, and about as many in one shard.
RUN = 1 << 22


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-logs * STEPS), 0, 65535).astype(np.uint16)


def count_codes(counts: np.ndarray) -> np.ndarray:
    large = EXACT + np.rint(np.log2(np.maximum(counts, EXACT) / EXACT) * 512)
    return np.where(counts < EXACT, counts, np.minimum(large, 65535)).astype(np.uint16)


def count_of(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float64)
    return np.where(codes < EXACT, codes, EXACT * np.exp2((codes - EXACT) / 512))


@dataclass
class Trie:
    """Where the levels are; ``starts`` has the number of the first node of each shard."""

    folder: str
    order: int
    weight: float
    tokens: int = 0
    words: int = 0
    starts: list[list[int]] = field(default_factory=list)

    def path(self, level: int, shard: int) -> str:
        return f"{self.folder}/level{level}/{shard:06d}.ef"


class Reader:
    """A trie opened by one worker."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.levels = [
            [EliasFano(trie.path(k + 1, s)) for s in range(len(starts))]
            for k, starts in enumerate(trie.starts)
        ]

    def find(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Number of the node with each key in a level; -1 if there is none."""
        shards = self.levels[level - 1]
        result = np.full(len(keys), -1, np.int64)
        if not shards:
            return result
        for s, part in parts_of(shard_of(keys, len(shards), level), len(shards)):
            if len(part):
                at = shards[s].find(keys[part])
                result[part] = np.where(at >= 0, at + self.trie.starts[level - 1][s], -1)
        return result

    def column(self, level: int, which: int, nodes: np.ndarray) -> np.ndarray:
        """A stored column at these nodes."""
        result = np.zeros(len(nodes), np.float64)
        for shard, part, at in self.places(level, nodes):
            result[part] = shard.columns[which][at]
        return result

    def keys(self, level: int, nodes: np.ndarray) -> np.ndarray:
        result = np.zeros(len(nodes), np.uint64)
        for shard, part, at in self.places(level, nodes):
            result[part] = shard.keys(at)
        return result

    def places(self, level: int, nodes: np.ndarray) -> Iterator[tuple]:
        """For each shard that has some of the nodes: it, which ones, and their places in it."""
        starts = self.trie.starts[level - 1]
        own = np.searchsorted(starts, nodes, side="right") - 1
        for s, part in parts_of(own, len(starts)):
            if len(part):
                yield self.levels[level - 1][s], part, nodes[part] - starts[s]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        trie = self.trie
        return (counts + ADDED) / (trie.tokens + ADDED * (trie.words + 1))

    def probability(
        self, level: int, nodes: np.ndarray, context: np.ndarray, lower: np.ndarray
    ) -> np.ndarray:
        """p(word | context): stored at ``nodes``; where -1, from the lower order and the
        count of the context (0: never seen)."""
        p = lower * (self.trie.weight / (context + self.trie.weight))
        seen = nodes >= 0
        p[seen] = np.power(10.0, -self.column(level, 0, nodes[seen]) / STEPS)
        return p


def parts_of(own: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard's number and the places where ``own`` has it, in order."""
    if shards <= 1 << 16:
        own = own.astype(np.uint16)  # sorted by counting, not by comparing
    order = np.argsort(own, kind="stable")
    bounds = np.searchsorted(own[order], np.arange(shards + 1)).tolist()
    for s in range(shards):
        yield s, order[bounds[s] : bounds[s + 1]]


def shard_of(keys: np.ndarray, shards: int, level: int) -> np.ndarray:
    """Level 1 is dealt out by the hash of the word, which is its key; others are hashed."""
    hashed = keys if level == 1 else mix(keys)
    return ((hashed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text, and the place of each text's first."""
    words, bounds = hashed_words(texts)
    tokens = np.insert(words, bounds[1:], END)
    return tokens, bounds + np.arange(len(bounds))


def ids_of(reader: Reader, tokens: np.ndarray) -> np.ndarray:
    """Number of each token's word; -1 for words that training has not seen."""
    distinct, places = np.unique(tokens, return_inverse=True)
    return reader.find(1, distinct)[places]


def child_keys(context: np.ndarray, word: np.ndarray, words: int) -> np.ndarray:
    return context.astype(np.uint64) * np.uint64(words) + word.astype(np.uint64)


def look_up(reader: Reader, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Nodes of (context, word); -1 where either is -1 or the pair was not seen."""
    result = np.full(len(word), -1, np.int64)
    known = (context >= 0) & (word >= 0)
    keys = child_keys(context[known], word[known], reader.trie.words)
    distinct, places = np.unique(keys, return_inverse=True)
    result[known] = reader.find(level, distinct)[places]
    return result


def contexts(reader: Reader, level: int, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each token, the node of the ``level`` tokens before it; -1 if there are none."""
    nodes = ids
    for k in range(1, level + 1):
        before = np.full(len(ids), -1, np.int64)
        before[1:] = nodes[:-1]
        before[first] = -1
        if k == level:
            return before
        nodes = look_up(reader, k + 1, before, ids)
    return nodes


def encode_run(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple[int, int, bytes, bytes]:
    """Differences of sorted keys and counts, byte by byte of their value, compressed."""
    packed = []
    for values in (np.diff(keys, prepend=np.uint64(0)), counts.astype(np.uint64)):
        planes = values.view(np.uint8).reshape(-1, 8).T
        packed.append(pa.compress(planes.tobytes(), "zstd", asbytes=True))
    return shard, len(keys), packed[0], packed[1]


def decode_run(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    result = []
    for data in (keys, counts):
        planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd"), np.uint8).reshape(8, n)
        result.append(np.ascontiguousarray(planes.T).view(np.uint64).ravel())
    return np.cumsum(result[0], dtype=np.uint64), result[1]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1))) if len(keys) else []
    if not len(keys):
        return keys, counts
    return keys[first], np.add.reduceat(counts, first)


def runs(texts: DataFrame, trie: Trie, level: int, shards: int) -> DataFrame:
    """Sorted runs of the n-grams of a level with their counts, one row per shard and run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(trie)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sent() -> pa.RecordBatch:
            keys, counts = summed(*map(np.concatenate, zip(*held, strict=True)))
            rows = [
                encode_run(s, keys[part], counts[part])
                for s, part in parts_of(shard_of(keys, shards, level), shards)
                if len(part)
            ]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["shard", "n", "keys", "counts"],
            )

        for batch in batches:
            for _, block in in_blocks(batch.column(0).to_pylist()):
                tokens, first = token_hashes(block)
                if level == 1:
                    keys = tokens
                else:
                    ids = ids_of(reader, tokens)
                    context = contexts(reader, level - 1, ids, first[:-1])
                    some = context >= 0
                    keys = child_keys(context[some], ids[some], trie.words)
                distinct, counts = np.unique(keys, return_counts=True)
                held.append((distinct, counts))
                size += len(distinct)
                if size >= RUN:
                    yield sent()
                    held, size = [], 0
        if size:
            yield sent()

    return texts.mapInArrow(run, "shard int, n long, keys binary, counts binary")


def build(rows: DataFrame, trie: Trie, level: int) -> list[tuple[int, int, int]]:
    """Merge the runs of each shard, store it, and return its number, nodes and tokens."""

    def merge(group: pa.Table) -> pa.Table:
        held = [
            decode_run(*run)
            for run in zip(*(group.column(c).to_pylist() for c in (1, 2, 3)), strict=True)
        ]
        keys, counts = summed(*map(np.concatenate, zip(*held, strict=True)))
        shard = group.column(0)[0].as_py()
        if level == 1:
            columns = [counts]
        else:
            reader = Reader(trie)
            context = (keys // np.uint64(trie.words)).astype(np.int64)
            word = (keys % np.uint64(trie.words)).astype(np.int64)
            lower = reader.unigram(reader.column(1, 0, word))
            if level == 2:
                above = reader.column(1, 0, context)
            else:
                above = count_of(reader.column(level - 1, 1, context))
                suffix = reader.keys(level - 1, context) % np.uint64(trie.words)
                suffix = suffix.astype(np.int64)
                lower = suffix_probability(reader, suffix, word, lower)
            p = (counts + trie.weight * lower) / (above + trie.weight)
            columns = [quantised(np.log10(p))]
            if level < trie.order:  # as contexts of the next level
                columns.append(count_codes(counts))
        write(trie.path(level, shard), keys, columns)
        return pa.table(
            {"shard": [shard], "nodes": [len(keys)], "tokens": [int(counts.sum())]},
            schema=pa.schema(
                [("shard", pa.int32()), ("nodes", pa.int64()), ("tokens", pa.int64())]
            ),
        )

    done = rows.groupBy("shard").applyInArrow(merge, "shard int, nodes long, tokens long")
    # three numbers per shard
    return [(r.shard, r.nodes, r.tokens) for r in done.collect()]


def suffix_probability(
    reader: Reader, before: np.ndarray, word: np.ndarray, lower: np.ndarray
) -> np.ndarray:
    """p(word | word before), for levels of three words."""
    nodes = look_up(reader, 2, before, word)
    return reader.probability(2, nodes, reader.column(1, 0, before), lower)


def train(
    documents: DataFrame,
    training: Column,
    text_column: str = "text",
    order: int = 2,
    weight: float = 4.0,
    workspace: Workspace | None = None,
) -> Trie:
    """Count the n-grams of all rows that meet ``training``, up to ``order`` words (1 to 3).

    Null counts as empty. Without training rows every level is empty. Only the numbers of
    nodes of each shard reach the driver.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    workspace = workspace or Workspace(documents.sparkSession)
    ship(documents.sparkSession)
    texts = documents.filter(training).select(
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text")
    )
    trie = Trie(workspace.folder("trie"), order, weight)
    shards = max(1, math.ceil(texts.count() / 16_384))
    for level in range(1, order + 1):
        if level > 1:
            shards = max(1, math.ceil(trie.tokens / RUN))
        done = {s: (n, t) for s, n, t in build(runs(texts, trie, level, shards), trie, level)}
        starts, total = [], 0
        for s in range(shards):
            if s not in done:  # an empty shard is a file too
                write(trie.path(level, s), np.zeros(0, np.uint64), empty_columns(trie, level))
            starts.append(total)
            total += done.get(s, (0, 0))[0]
        if level == 1:
            trie.words, trie.tokens = total, sum(t for _, t in done.values())
            if trie.words == 0:
                trie.starts = [[] for _ in range(order)]
                break
        trie.starts.append(starts)
    return trie


def empty_columns(trie: Trie, level: int) -> list[np.ndarray]:
    if level == 1:
        return [np.zeros(0, np.int64)]
    return [np.zeros(0, np.uint16)] * (2 if level < trie.order else 1)


def scores(
    documents: DataFrame, trie: Trie, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Whole texts, an end token after each; A-Z in lower case. ``base_score`` adds log10 of the
    smoothed single-word probabilities, ``score`` is the trie's log10 probability of the
    text. Null and empty texts have the end token only. Words are told apart by 64-bit
    hashes. Repeated rows are scored alike, an empty table gives no rows, other columns are
    ignored; nothing is shuffled.
    """
    ship(documents.sparkSession)
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(trie)
        for batch in batches:
            found = [
                score_block(reader, block) for _, block in in_blocks(batch.column(1).to_pylist())
            ]
            if not found:
                continue
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(np.full(len(columns[0]), trie.tokens), pa.int64()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.float64()),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def score_block(reader: Reader, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    tokens, bounds = token_hashes(texts)
    first = bounds[:-1]
    ids = ids_of(reader, tokens)
    known = ids >= 0
    counts = np.zeros(len(ids), np.float64)
    counts[known] = reader.column(1, 0, ids[known])
    single = reader.unigram(counts)
    p = single
    if reader.trie.order >= 2 and reader.trie.words:
        before = contexts(reader, 1, ids, first)
        pairs = look_up(reader, 2, before, ids)
        above = np.zeros(len(ids), np.float64)
        above[1:] = counts[:-1]
        above[first] = 0
        p = reader.probability(2, pairs, above, single)
        if reader.trie.order >= 3:
            context = np.full(len(ids), -1, np.int64)
            context[1:] = pairs[:-1]
            context[first] = -1
            above = np.zeros(len(ids), np.float64)
            some = context >= 0
            above[some] = count_of(reader.column(2, 1, context[some]))
            p = reader.probability(3, look_up(reader, 3, context, ids), above, p)
    return (
        np.diff(bounds),
        np.add.reduceat(known.astype(np.int64), first),
        np.add.reduceat(np.log10(single), first),
        np.add.reduceat(np.log10(p), first),
    )
