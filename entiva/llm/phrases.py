"""Phrase collocations, counted by a prefix-free parse.

Texts are cut where their content says so: a chunk starts at every word that begins three
words with a hash which a modulus divides, and ends with the three words that begin the next
chunk. So equal passages give equal chunks wherever they stand, no chunk begins another, and
the corpus becomes a dictionary of distinct chunks with their frequencies. Phrases are counted
inside the distinct chunks only, weighted by frequency. Chunks overlap by three words, so every
phrase of up to four words lies whole in one; a phrase belongs to the chunk that it starts in,
ahead of the three shared words, and is counted once (a text's last chunk owns all its words).

Most phrases of a corpus are rare, and so is a phrase with a rare pair of words. Words and
pairs are therefore counted first by hash, five bytes each, and what is frequent marks bits in
a table of bounded size; then phrases whose words and pairs are all marked are counted by
their text. A mark too many costs a row and no error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiva.llm.common import ship, text_or_empty
from entiva.llm.words import mix
from entiva.session import Workspace

#: Marks that end a piece, besides the end of the text, and the blanks between words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
LONGEST = 4
SHARED = LONGEST - 1
#: One word in so many starts a chunk.
MODULUS = 16
UNKNOWN = "und"
#: Parts that a language's candidates are ranked in before the best of all parts meet.
RANK_PARTS = 64

#: Bytes of text that are worked on at once; a longer text by itself.
BLOCK_BYTES = 4 << 20
#: Bytes that have an index of eight bytes each at the same time.
SLICE_BYTES = 1 << 20
#: Hashed words and pairs that a task gathers before it sends them.
GATHERED = 1 << 22
#: Hashed words and pairs that one task adds up, about.
KEYS_PER_SHARD = 1 << 23
#: The table of marks: bits for each frequent word or pair, and the most bits in all (64 MB).
BITS_PER_MARK, MOST_BITS = 32, 29

_break, _gap = np.zeros(256, bool), np.zeros(256, bool)
_break[list(BREAKS)] = True
_gap[list(BREAKS + BLANKS)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_FIRST, _SECOND = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC2B2AE3D27D4EB4F)
_NEXT = np.uint64(0x9FB21C651E98DF25)


class Words:
    """The words of some texts, by place: bytes in lower case, where a word starts and ends,
    whether a piece ends after it, and the first word of each text (and one more)."""

    def __init__(self, texts: list[bytes]):
        self.data = _lower[np.frombuffer(b"\n".join(texts), np.uint8)]
        inside = ~_gap[self.data]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, offsets)
        seen = np.concatenate([[0], np.cumsum(_break[self.data], dtype=np.int64)])
        self.breaks = np.ones(len(self.starts), bool)
        self.breaks[:-1] = seen[self.starts[1:]] > seen[self.ends[:-1]]

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, base: np.uint64) -> np.ndarray:
        """A 64-bit hash of every word, a polynomial of its bytes."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        powers = np.full(int(lengths.max()), base, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        sums = np.zeros(len(lengths), np.uint64)
        for part in _slices(lengths):
            sizes = lengths[part]
            values = self.data[_ranges(self.starts[part], sizes)].astype(np.uint64) + np.uint64(1)
            values *= powers[_ranges(np.zeros_like(sizes), sizes)]
            sums[part] = np.add.reduceat(values, np.cumsum(sizes) - sizes)
        return mix(sums + lengths.astype(np.uint64))

    def within(self, words: int) -> np.ndarray:
        """Whether so many words from each on stand in one piece."""
        there = np.ones(len(self), bool)
        for step in range(words - 1):
            there[: len(self) - step] &= ~self.breaks[step:]
            there[max(0, len(self) - step) :] = False
        return there

    def joined(self, begin: np.ndarray, words: np.ndarray) -> pa.Array:
        """The text of each run of words: blanks between them, line feeds where pieces end."""
        place = _ranges(begin, words)
        last = np.cumsum(words) - 1
        lengths = self.ends[place] - self.starts[place] + 1
        lengths[last] -= 1
        ends = np.cumsum(lengths)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        for part in _slices(lengths):
            bytes_of = _ranges(self.starts[place[part]], lengths[part])
            begin_at = ends[part.start] - lengths[part.start]
            out[begin_at : ends[part.stop - 1]] = self.data.take(bytes_of, mode="clip")
        gaps = np.ones(len(place), bool)
        gaps[last] = False
        out[ends[gaps] - 1] = np.where(self.breaks[place[gaps]], 10, 32)
        offsets = np.concatenate([[0], ends[last]]).astype(np.int32)
        return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(out))


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begin[0], begin[0] + 1, ...`` (``sizes[0]`` of them), then the same of ``begin[1]``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - sizes), sizes)


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Stretches of items whose sizes add up to about ``SLICE_BYTES``, one item at least."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        most = ends[begin] - sizes[begin] + SLICE_BYTES
        end = max(begin + 1, int(np.searchsorted(ends, most, "right")))
        yield slice(begin, end)
        begin = end


def _after(hashes: np.ndarray, words: np.ndarray, step: int) -> np.ndarray:
    """Hashes of runs, each made longer by the word ``step`` places on; the ends stay."""
    longer = hashes.copy()
    if step < len(words):
        longer[: len(words) - step] = mix(hashes[: len(words) - step] * _NEXT + words[step:])
    return longer


def _blocks(texts: list[bytes]) -> Iterator[slice]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > BLOCK_BYTES:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def cut(words: Words, modulus: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every chunk its text, first word, number of own words and whether it is the last."""
    of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    own = words.hashes(_FIRST)
    three = _after(_after(own, own, 1), own, 2)
    opens = three % np.uint64(modulus) == 0
    opens[max(0, len(words) - SHARED + 1) :] = False
    ahead = len(words) - SHARED + 1
    if ahead > 0:
        opens[:ahead] &= of[:ahead] == of[SHARED - 1 :]
    opens[words.first[:-1][np.diff(words.first) > 0]] = True
    begin = np.flatnonzero(opens)
    after = np.append(begin[1:], len(words))
    last = np.ones(len(begin), bool)
    last[:-1] = of[begin[1:]] != of[begin[:-1]]
    return of[begin], begin, after - begin, last


def chunks(
    documents: DataFrame, text_column: str, lang_column: str, modulus: int = MODULUS
) -> DataFrame:
    """The parse of each text, in order: ``lang, chunk, last, own`` (number of own words)."""
    ship(documents.sparkSession)
    rows = documents.select(
        F.coalesce(F.col(lang_column), F.lit(UNKNOWN)).alias("lang"),
        text_or_empty(text_column).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in _blocks(texts):
                words = Words(texts[part])
                if not len(words):
                    continue
                of, begin, own, last = cut(words, modulus)
                size = own + np.where(last, 0, SHARED)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(of + part.start)),
                        words.joined(begin, size),
                        pa.array(last),
                        pa.array(own.astype(np.int64)),
                    ],
                    names=["lang", "chunk", "last", "own"],
                )

    return rows.mapInArrow(run, "lang string, chunk string, last boolean, own long")


def dictionary(parse: DataFrame) -> DataFrame:
    """Distinct chunks and how often the parse has them."""
    return parse.groupBy("lang", "chunk", "last").agg(
        F.max("own").alias("own"), F.count(F.lit(1)).alias("times")
    )


class Phrases:
    """The words of some rows of the dictionary, and hashes of the phrases that start at each.

    The first hashes tell languages apart too.
    """

    def __init__(self, batch: pa.RecordBatch, part: slice, texts: list[bytes]):
        self.words = Words(texts[part])
        counts = np.diff(self.words.first)
        rows = np.arange(part.start, part.start + len(counts))
        self.row = np.repeat(rows, counts)
        own = batch.column("own").to_numpy()
        self.owned = _ranges(np.zeros_like(counts), counts) < own[self.row]
        self.times = batch.column("times").to_numpy()[self.row]
        self.plain = self.words.hashes(_FIRST)
        langs = batch.column("lang").dictionary_encode()
        salts = np.array(
            [
                int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
                for name in langs.dictionary.to_pylist()
            ],
            np.uint64,
        )
        self.single = mix(self.plain ^ salts[langs.indices.to_numpy()[self.row]])
        self.pair = _after(self.single, self.plain, 1)
        self.paired = self.words.within(2)


def _phrases_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Phrases]]:
    for batch in batches:
        texts = batch.column("chunk").cast(pa.binary()).to_pylist()
        for part in _blocks(texts):
            yield batch, Phrases(batch, part, texts)


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's weights."""
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    begin = np.flatnonzero(np.diff(keys, prepend=keys[:1] + 1))
    return keys[begin], np.add.reduceat(weights, begin)


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)


def hashed_counts(chunk_counts: DataFrame, shard_bits: int) -> DataFrame:
    """Counts of words and pairs by hash, up to 255, packed by shard (first bits of the hash):
    ``shard, rests, counts`` with the 32 bits that follow the shard's, and a byte each."""

    def packed(gathered: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = _sums(*(np.concatenate(x) for x in zip(*gathered, strict=True)))
        shards = _top(keys, shard_bits)
        rests = (_top(keys, shard_bits + 32) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        counts = np.minimum(counts, 255).astype(np.uint8)
        begin = np.flatnonzero(np.diff(shards, prepend=shards[:1] + np.uint64(1)))
        bounds = list(zip(begin, np.append(begin[1:], len(keys)), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(shards[begin].astype(np.int32)),
                pa.array([rests[a:b].tobytes() for a, b in bounds], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in bounds], pa.binary()),
            ],
            names=["shard", "rests", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for _, found in _phrases_of(batches):
            for hashes, there in (
                (found.single, found.owned),
                (found.pair, found.owned & found.paired),
            ):
                if there.any():
                    gathered.append((hashes[there], found.times[there]))
                    size += len(gathered[-1][0])
            if size >= GATHERED:
                yield packed(gathered)
                gathered, size = [], 0
        if gathered:
            yield packed(gathered)

    return chunk_counts.mapInArrow(run, "shard int, rests binary, counts binary")


def frequent_hashes(counts: DataFrame, least: int) -> DataFrame:
    """``shard, rests, n`` of the hashes whose counts add up to ``least`` or more."""
    enough = min(least, 255)

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        rests = np.concatenate([np.frombuffer(r, np.uint32) for r in rows["rests"]])
        times = np.concatenate([np.frombuffer(c, np.uint8) for c in rows["counts"]])
        rests, times = _sums(rests, times.astype(np.uint32))
        rests = rests[times >= enough]
        return pd.DataFrame(
            {"shard": [int(rows["shard"].iloc[0])], "rests": [rests.tobytes()], "n": [len(rests)]}
        )

    return counts.groupBy("shard").applyInPandas(add_up, "shard int, rests binary, n long")


def mark_table(frequent: DataFrame, shard_bits: int) -> tuple[int, np.ndarray]:
    """Bits of an index, and the table of marks, packed: at most ``2 ** MOST_BITS`` bits.

    Every shard fills its own stretch of the table, so the driver gets each bit once.
    """
    total = frequent.agg(F.sum("n")).first()[0] or 0
    bits = min(MOST_BITS, max(16, (BITS_PER_MARK * total).bit_length()))
    bits = max(bits, shard_bits + 3)
    own = bits - shard_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stretches = []
            for rests in batch.column("rests").to_pylist():
                marks = np.zeros(1 << own, np.uint8)
                marks[np.frombuffer(rests, np.uint32) >> np.uint32(32 - own)] = 1
                stretches.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array(stretches, pa.binary())], names=["shard", "marks"]
            )

    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in frequent.filter("n > 0").mapInArrow(run, "shard int, marks binary").collect():
        stretch = np.frombuffer(row.marks, np.uint8)
        table[row.shard * len(stretch) :][: len(stretch)] = stretch
    return bits, table


def _marked(hashes: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    index = _top(hashes, bits)
    return (table[index >> np.uint64(3)] >> (index & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def phrase_counts(
    chunk_counts: DataFrame, marks: tuple[int, np.ndarray], least: int
) -> DataFrame:
    """``lang, phrase, words, f`` of all phrases of one to four words with ``least`` or more."""
    sent = chunk_counts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table = sent.value
        for batch, found in _phrases_of(batches):
            other = found.words.hashes(_SECOND)
            first, second = found.single, other
            marked = _marked(found.single, bits, table)
            pairs = found.paired & _marked(found.pair, bits, table)
            for size in range(1, LONGEST + 1):
                if size > 1:
                    first = _after(first, found.plain, size - 1)
                    second = _after(second, other, size - 1)
                    # the pair that the phrase ends with is marked as well
                    before = size - 2
                    ends = np.zeros(len(pairs), bool)
                    ends[: len(pairs) - before] = pairs[before:]
                    marked = (marked & ends) if size > 2 else pairs
                at = np.flatnonzero(marked & found.owned & found.words.within(size))
                if not len(at):
                    continue
                # equal phrases of these rows are sent once; two hashes tell phrases apart
                order = np.lexsort((second[at], first[at]))
                at = at[order]
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(first[at]) != 0) | (np.diff(second[at]) != 0)
                begin = np.flatnonzero(new)
                once = at[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").take(pa.array(found.row[once])),
                        found.words.joined(once, np.full(len(once), size)),
                        pa.array(np.full(len(once), size, np.int32)),
                        pa.array(np.add.reduceat(found.times[at], begin)),
                    ],
                    names=["lang", "phrase", "words", "f"],
                )

    return (
        chunk_counts.mapInArrow(run, "lang string, phrase string, words int, f long")
        .groupBy("lang", "phrase", "words")
        .agg(F.sum("f").alias("f"))
        .filter(F.col("f") >= least)
    )


def _end(phrase: Column, words: Column) -> Column:
    """The first so many words, or the last if the number is negative."""
    return F.call_function("substring_index", phrase, F.lit(" "), words)


def weakest_cuts(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, phrase, words, a, l, r, score``.

    Both parts of a phrase occur at least as often as it does, so they are in ``counts``.
    """
    cuts = counts.filter("words > 1").select(
        "lang",
        "phrase",
        "words",
        F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    )
    cuts = cuts.withColumns(
        {
            "front": _end(F.col("phrase"), F.col("k")),
            "rest": _end(F.col("phrase"), F.col("k") - F.col("words")),
        }
    )
    fronts = counts.select("lang", F.col("phrase").alias("front"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # decimals, as the product may pass 64 bits
    score = F.expr(
        "cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    )
    return (
        cuts.join(fronts, ["lang", "front"])
        .join(rests, ["lang", "rest"])
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("weakest"))
        .select("lang", "phrase", "words", "a", "weakest.l", "weakest.r", "weakest.score")
    )


def not_covered(candidates: DataFrame, share: int = 80) -> DataFrame:
    """Without the candidates that stand inside a longer one which occurs ``share`` percent as
    often or more, whether or not that one stays."""
    spans = [
        F.struct(F.lit(begin).alias("begin"), F.lit(size).alias("size"), F.lit(of).alias("of"))
        for of in range(3, LONGEST + 1)
        for size in range(2, of)
        for begin in range(of - size + 1)
    ]
    longer = candidates.filter("words > 2").select(
        "lang",
        "words",
        F.split("phrase", " ").alias("split"),
        F.col("a").alias("longer"),
        F.explode(F.array(*spans)).alias("span"),
    )
    part = F.slice("split", F.col("span.begin") + 1, F.col("span.size"))
    inside = (
        longer.filter(F.col("span.of") == F.col("words"))
        .select("lang", F.array_join(part, " ").alias("phrase"), "longer")
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    exact = "cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {share}"
    covered = F.coalesce(F.expr(exact.format(share=share)), F.lit(False))
    return candidates.join(inside, ["lang", "phrase"], "left").filter(~covered).drop("longer")


def best_per_language(candidates: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language with their ``rank``. Parts of a language are ranked
    first, so what meets in one task does not grow with the number of candidates."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    of_part = Window.partitionBy("lang", "part").orderBy(*order)
    few = (
        candidates.withColumn("part", part)
        .withColumn("rank", F.row_number().over(of_part))
        .filter(F.col("rank") <= most)
    )
    of_all = Window.partitionBy("lang").orderBy(*order)
    ranked = few.withColumn("rank", F.row_number().over(of_all)).filter(F.col("rank") <= most)
    return ranked.drop("part").withColumn("rank", F.col("rank").cast("long"))


def collocations(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = 30,
    most: int = 2000,
    modulus: int = MODULUS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best ``most`` phrases per language.

    Texts in lower case (A-Z) are split at marks and line ends, and phrases of two to four
    words are counted within the pieces, overlapping ones included, per language (null:
    ``und``). Candidates occur ``least`` times or more and score by their weakest cut; those
    inside a longer one of 80 percent their frequency go. ``n`` counts all words of the
    language. Null and empty texts have no words; repeated rows count as often as they occur;
    an empty table gives no rows, and other columns are ignored. A text or piece may be of any
    length. The dictionary and the counts are written to the shared folder.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    parse = chunks(documents, text_column, lang_column, modulus)
    chunk_counts = workspace.keep(dictionary(parse), "chunks")
    totals = workspace.keep(
        chunk_counts.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n")), "totals"
    )
    places = chunk_counts.agg(F.sum("own")).first()[0] or 0
    shard_bits = max(0, (2 * places // KEYS_PER_SHARD).bit_length())
    frequent = workspace.keep(
        frequent_hashes(hashed_counts(chunk_counts, shard_bits), least), "frequent"
    )
    marks = mark_table(frequent, shard_bits)
    counts = workspace.keep(phrase_counts(chunk_counts, marks, least), "phrases")
    workspace.drop("chunks")
    candidates = workspace.keep(weakest_cuts(counts), "candidates")
    best = best_per_language(not_covered(candidates), most)
    return best.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
