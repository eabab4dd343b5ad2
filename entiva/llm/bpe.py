r"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word is a row of symbols; leaf *i* of its tree holds the rank of the pair that starts at
symbol *i* (with the position, so that equal ranks go left first). The root is thus the
leftmost pair of lowest rank. Merging it clears one leaf and changes two more; each change
walks one path to the root. This goes on until the root holds no pair.

Trees of equally long words are the rows of one array, so NumPy takes a step of all of them
at once. Words are found by white space, and their ids are remembered per Python worker, up to a
fixed number of words; a full memory is emptied, which changes speed only.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiva.llm.common import ship

#: Bytes of a vocabulary file that may be sent to every worker.
MOST_VOCABULARY = 64 << 20

#: Words one worker remembers, and the longest that it does.
MEMORY_WORDS = 300_000
MEMORY_CHARS = 64

NO_PAIR = np.int64(2**62)
_odd_space = re.compile("[\x1c-\x1f]")
_white = re.compile("[\t-\r \x85\xa0  -     　]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Vocabulary:
    """A BPE vocabulary with word ends, as stored in a tokenizer's JSON file."""

    def __init__(self, content: bytes):
        import regex

        spec = json.loads(content)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.tokens = [""] * (1 + max([*ids.values(), *special.values()]))
        for token, i in [*ids.items(), *special.items()]:
            self.tokens[i] = token
        self.split_special = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        self.pieces = regex.compile(
            spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        ).findall
        symbols = byte_symbols()
        self.inner = np.array([ids[c] for c in symbols], np.int64)
        self.final = np.array([ids[c + self.suffix] for c in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        # pairs and ranks in a hash table with linear probing
        self.mask = (1 << (4 * len(keys)).bit_length()) - 1
        self.table = np.full((self.mask + 1, 2), (-1, NO_PAIR), np.int64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self.slots(keys).tolist())):
            while self.table[slot, 0] >= 0:
                slot = slot + 1 & self.mask
            self.table[slot] = key, rank

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys * np.int64(0x1E3779B97F4A7C15)) >> 20
        return (mixed ^ mixed >> 17) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_PAIR where it cannot be merged or a side is missing (-1)."""
        keys = np.where((left < 0) | (right < 0), np.int64(1) << 60, left << 20 | right)
        slots = self.slots(keys)
        held = self.table[slots, 0]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = slots[open_] + 1 & self.mask
            held = self.table[slots[open_], 0]
            open_ = open_[(held != keys[open_]) & (held >= 0)]
        return self.table[slots, 1]


def merge_all(symbols: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Merge each row of equally long words to the end; what is merged away becomes -1."""
    words, length = symbols.shape
    if length < 2:
        return symbols
    width = 1 << (length - 1).bit_length()
    symbols = symbols.copy()
    following = np.tile(np.arange(1, length + 1), (words, 1))  # the next living symbol
    previous = np.tile(np.arange(-1, length - 1), (words, 1))
    tree = np.full((words, 2 * width), NO_PAIR)
    pairs = symbols[:, :-1].ravel(), symbols[:, 1:].ravel()
    ranks = vocabulary.ranks(*pairs).reshape(words, length - 1)
    places = np.arange(length - 1)
    tree[:, width : width + length - 1] = np.where(ranks == NO_PAIR, NO_PAIR, ranks << 24 | places)
    level = width
    while level > 1:
        level >>= 1
        tree[:, level : 2 * level] = tree[:, 2 * level : 4 * level].reshape(words, level, 2).min(2)
    # from here on all arrays are flat; a word's row starts at its number times the row's size
    tree, symbols = tree.reshape(-1), symbols.reshape(-1)
    following, previous = following.reshape(-1), previous.reshape(-1)
    busy = np.flatnonzero(tree[1 :: 2 * width] != NO_PAIR)
    while len(busy):
        row, top = busy * length, busy * (2 * width)
        root = tree[top + 1]
        rank, left = root >> 24, root & 0xFFFFFF
        at_left = row + left
        right = following[at_left]
        after = following[row + right]
        before = previous[at_left]
        here = vocabulary.merged[rank]
        symbols[at_left] = here
        symbols[row + right] = -1
        following[at_left] = after
        has_after, has_before = after < length, before >= 0
        at_after = row + np.where(has_after, after, left)
        previous[at_after[has_after]] = left[has_after]
        next_symbol = np.where(has_after, symbols[at_after], -1)
        before = np.where(has_before, before, width - 1)  # the last leaf never holds a pair
        last_symbol = np.where(has_before, symbols[row + np.where(has_before, before, 0)], -1)
        both = vocabulary.ranks(
            np.concatenate([here, last_symbol]), np.concatenate([next_symbol, here])
        )
        places = np.concatenate([right, left, before])
        ranks = np.concatenate([np.full(len(busy), NO_PAIR), both])
        node = places + width
        tops = np.concatenate([top, top, top])
        tree[tops + node] = np.where(ranks == NO_PAIR, NO_PAIR, ranks << 24 | places)
        depth = width
        while depth > 1:  # the three paths of a word rise level by level
            node >>= 1
            at = tops + node
            children = at + node
            tree[at] = np.minimum(tree[children], tree[children + 1])
            depth >>= 1
        busy = busy[tree[top + 1] != NO_PAIR]
    return symbols.reshape(words, length)


def merge_word(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same for one word, where steps over arrays of one row would cost too much."""
    length = len(symbols)
    if length < 2:
        return symbols
    width = 1 << (length - 1).bit_length()
    none = int(NO_PAIR)
    rank_of, merged = vocabulary.rank_of, vocabulary.merged
    symbols = list(symbols)
    following = list(range(1, length + 1))
    previous = list(range(-1, length - 1))
    tree = [none] * (2 * width)
    for i in range(length - 1):
        rank = rank_of.get(symbols[i] << 20 | symbols[i + 1])
        if rank is not None:
            tree[width + i] = rank << 24 | i
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(place: int, value: int) -> None:
        node = width + place
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    while tree[1] != none:
        rank, left = tree[1] >> 24, tree[1] & 0xFFFFFF
        right = following[left]
        after, before = following[right], previous[left]
        symbols[left], symbols[right] = int(merged[rank]), -1
        following[left] = after
        put(right, none)
        ahead = None
        if after < length:
            previous[after] = left
            ahead = rank_of.get(symbols[left] << 20 | symbols[after])
        put(left, none if ahead is None else ahead << 24 | left)
        if before >= 0:
            behind = rank_of.get(symbols[before] << 20 | symbols[left])
            put(before, none if behind is None else behind << 24 | before)
    return [s for s in symbols if s >= 0]


#: Fewer words of one length than this are merged one by one.
FEW_WORDS = 20

#: Symbols that one array of trees may hold.
BLOCK_SYMBOLS = 1 << 20


class Encoder:
    """Encodes and decodes texts; remembers the words it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.memory: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The text in normal form, cut at white space."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # one character at a time, so that a final sigma is no exception
        text = text.replace("Σ", "σ").lower()
        if _odd_space.search(text):
            return [w for w in _white.split(text) if w]
        return text.split()

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of each distinct piece between two word ends."""
        by_length: dict[int, list[bytes]] = {}
        for piece in set(pieces):
            by_length.setdefault(len(piece), []).append(piece)
        found: dict[bytes, bytes] = {}
        for length, group in by_length.items():
            step = max(1, BLOCK_SYMBOLS // length)
            for start in range(0, len(group), step):
                block = group[start : start + step]
                raw = np.frombuffer(b"".join(block), np.uint8).reshape(len(block), length)
                symbols = self.vocabulary.inner[raw]
                symbols[:, -1] = self.vocabulary.final[raw[:, -1]]
                if len(block) < FEW_WORDS:
                    for piece, row in zip(block, symbols.tolist(), strict=True):
                        own = merge_word(row, self.vocabulary)
                        found[piece] = np.array(own, "<u4").tobytes()
                    continue
                merged = merge_all(symbols, self.vocabulary)
                alive = merged >= 0
                ids = merged[alive].astype("<u4").tobytes()
                ends = (4 * alive.sum(1).cumsum()).tolist()
                for piece, begin, end in zip(block, [0, *ends], ends):
                    found[piece] = ids[begin:end]
        return found

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids (little-endian, 32 bits) of words not yet remembered."""
        pieces = {
            w: [w.encode()] if w.isalpha() else [p.encode() for p in self.vocabulary.pieces(w)]
            for w in words
        }
        ids = self.encode_pieces([p for ps in pieces.values() for p in ps])
        return {w: b"".join([ids[p] for p in ps]) for w, ps in pieces.items()}

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text."""
        vocabulary = self.vocabulary
        parts: list[list[list[str] | bytes]] = []
        unknown: set[str] = set()
        memory = self.memory
        for text in texts:
            own: list[list[str] | bytes] = []
            if vocabulary.special and "<" in text:
                for i, piece in enumerate(vocabulary.split_special.split(text)):
                    own.append(vocabulary.special[piece] if i % 2 else self.words(piece))
            else:
                own.append(self.words(text))
            parts.append(own)
            for words in own:
                if not isinstance(words, bytes):
                    unknown.update(words)
        fresh = self.learn({w for w in unknown if w not in memory})
        if len(memory) + len(fresh) > MEMORY_WORDS:
            memory.clear()
            fresh = self.learn({w for own in parts for ws in own if ws.__class__ is list for w in ws})
        memory.update(fresh)
        for own in parts:
            yield b"".join(
                [
                    words if isinstance(words, bytes) else b"".join([memory[w] for w in words])
                    for words in own
                ]
            )
        for word in fresh:
            if len(word) > MEMORY_CHARS:
                del memory[word]

    def decode(self, packed: bytes) -> str:
        """The tokens of packed ids, special ones too, joined by one space."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


#: Characters that one call of the encoder takes; a longer text is a call of its own.
CALL_CHARS = 4_000_000


def in_calls(texts: list[str]) -> Iterator[list[str]]:
    call: list[str] = []
    size = 0
    for text in texts:
        if call and size + len(text) > CALL_CHARS:
            yield call
            call, size = [], 0
        call.append(text)
        size += len(text)
    if call:
        yield call


def encode(
    documents: DataFrame,
    vocabulary_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    digests: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row, in no order; nothing is shuffled.

    ``ids`` is an array of ints and ``decoded`` the text they stand for; with ``digests``
    both are replaced by SHA-256 (``ids_sha256`` over 32-bit little-endian ids,
    ``decoded_sha256`` over UTF-8), so that no ids leave the worker. Null and empty texts
    have no tokens. Special tokens written in a text are encoded as such. The vocabulary
    file is read on the driver and sent to the workers, its size checked; repeated rows and rows
    with a null id are encoded each by itself; an empty table gives no rows.
    """
    ship(documents.sparkSession)
    with open(vocabulary_path, "rb") as file:
        content = file.read(MOST_VOCABULARY + 1)
    if len(content) > MOST_VOCABULARY:
        raise ValueError(f"{vocabulary_path} has more than {MOST_VOCABULARY} bytes")
    sent = documents.sparkSession.sparkContext.broadcast(content)
    kind = documents.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts, first, second = [], [], []
            for call in in_calls(texts):
                for packed in encoder.batch(call):
                    decoded = encoder.decode(packed)
                    counts.append(len(packed) // 4)
                    if digests:
                        first.append(hashlib.sha256(packed).hexdigest())
                        second.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        first.append(np.frombuffer(packed, "<u4").astype(np.int32))
                        second.append(decoded)
            kinds = pa.string() if digests else pa.list_(pa.int32())
            columns = [batch.column(0), pa.array(counts, pa.int64())]
            columns += [pa.array(first, kinds), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", *(DIGESTS if digests else ("ids", "decoded"))]
    types = [kind, "long", "string" if digests else "array<int>", "string"]
    rows = documents.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))


DIGESTS = ("ids_sha256", "decoded_sha256")
_encoders: dict[bytes, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    """One encoder per worker and vocabulary."""
    key = hashlib.sha256(content).digest()
    if key not in _encoders:
        _encoders[key] = Encoder(Vocabulary(content))
    return _encoders[key]
