"""Sorted integers in Elias-Fano form, in files that are mapped into memory.

The upper bits of the keys are a unary bit vector, which points from each bucket of keys to
its first member and only grows; the lower bits are packed at a fixed width. A key is looked
up by two selects in the bit vector and a binary search between them, for many keys at once.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np

_HEADER = 8  # numbers of 64 bits
_one = np.uint64(1)


def pack_low(keys: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` low bits of each key, one after the other, in 64-bit words."""
    words = np.zeros(len(keys) * width // 64 + 2, np.uint64)
    if width == 0:
        return words
    low = keys & np.uint64((1 << width) - 1)
    bit = np.arange(len(keys), dtype=np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    np.bitwise_or.at(words, word, low << shift)
    over = shift + np.uint64(width) > np.uint64(64)
    np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
    return words


def write(path: str, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """Store sorted distinct ``keys`` (64 bits) and columns of equal length.

    Written under another name and renamed, so that a repeated task leaves one whole file.
    """
    n = len(keys)
    universe = int(keys[-1]) + 1 if n else 1
    width = max(0, (universe // max(n, 1)).bit_length() - 1)
    high = (keys >> np.uint64(width)).astype(np.int64)
    bits = n + (int(high[-1]) + 1 if n else 0)
    marks = np.zeros(-(-bits // 64) * 64, np.uint8)
    marks[high + np.arange(n)] = 1
    upper = np.packbits(marks, bitorder="little").view(np.uint64)
    zeros = np.cumsum(64 - np.bitwise_count(upper).astype(np.int64)).astype(np.uint32)
    low = pack_low(keys, width)
    parts = [upper, zeros, low, *columns]
    header = np.zeros(_HEADER + 2 * len(parts), np.int64)
    header[:4] = n, width, int(high[-1]) + 1 if n else 0, len(parts)
    kinds = [np.dtype(p.dtype) for p in parts]
    header[_HEADER :: 2] = [len(p) for p in parts]
    header[_HEADER + 1 :: 2] = [k.itemsize for k in kinds]
    store(path, [header, *parts])


def on_disk(path: str) -> str:
    """The name of a file that is given by name or as ``file:/…`` or ``file:///…``; others stay."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:/") else path


def store(path: str, parts: list[np.ndarray]) -> None:
    local = on_disk(path)
    if "://" not in local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        own = f"{local}.{uuid.uuid4().hex}"
        with open(own, "wb") as file:
            for part in parts:
                file.write(_padded(part))
        os.replace(own, local)
        return
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    own = f"{inner}.{uuid.uuid4().hex}"
    system.create_dir(os.path.dirname(inner), recursive=True)
    with system.open_output_stream(own) as file:
        for part in parts:
            file.write(_padded(part))
    system.move(own, inner)


def _padded(part: np.ndarray) -> bytes:
    data = part.tobytes()
    return data + bytes(-len(data) % 8)


def mapped(path: str) -> np.ndarray:
    """The file's bytes, read on demand. A file in another store is copied first, and the
    copy, already without a name, goes with the map."""
    local = on_disk(path)
    if "://" not in local:
        return np.memmap(local, np.uint8, "r")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with tempfile.NamedTemporaryFile() as copy:
        with system.open_input_stream(inner) as file:
            while block := file.read(1 << 22):
                copy.write(block)
        copy.flush()
        return np.memmap(copy.name, np.uint8, "r")


_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
# place of the r-th one of a byte, at 8 * byte + r
_in_byte = np.zeros(256 * 8, np.uint8)
for _byte in range(256):
    _set = [k for k in range(8) if _byte >> k & 1]
    _in_byte[8 * _byte : 8 * _byte + len(_set)] = _set


def _nth(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one with this rank (from 0) in each 64-bit word."""
    # ones of each pair, nibble, byte; then of each byte and all below it
    upto = words - (words >> np.uint64(1) & np.uint64(0x5555555555555555))
    fours = np.uint64(0x3333333333333333)
    upto = (upto & fours) + (upto >> np.uint64(2) & fours)
    upto = (upto + (upto >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH
    passed = np.bitwise_count((rank * _EACH | _TOP) - upto & _TOP).astype(np.uint64) << np.uint64(3)
    before = (upto << np.uint64(8)) >> passed & np.uint64(255)
    byte = words >> passed & np.uint64(255)
    return passed.astype(np.int64) + _in_byte[(byte << np.uint64(3)) + (rank - before)]


class EliasFano:
    """One stored sequence and its columns."""

    def __init__(self, path: str):
        raw = mapped(path)
        head = raw[: 8 * _HEADER].view(np.int64)
        self.n, self.width, self.buckets, parts = (int(x) for x in head[:4])
        sizes = raw[8 * _HEADER : 8 * (_HEADER + 2 * parts)].view(np.int64)
        at = 8 * (_HEADER + 2 * parts)
        found = []
        for length, item in zip(sizes[::2].tolist(), sizes[1::2].tolist(), strict=True):
            found.append(np.asarray(raw[at : at + length * item].view(f"u{item}")))
            at += -(-length * item // 8) * 8
        self.upper, self.zeros, self.low = found[:3]
        self.columns = found[3:]

    def _zero(self, number: np.ndarray) -> np.ndarray:
        """Places of the zeros with these numbers."""
        word = np.searchsorted(self.zeros, number, side="right")
        before = np.where(word > 0, self.zeros[np.maximum(word, 1) - 1], 0).astype(np.int64)
        return word * 64 + _nth(~self.upper[word], (number - before).astype(np.uint64))

    def keys(self, index: np.ndarray) -> np.ndarray:
        """The keys at these places."""
        if not hasattr(self, "_ones"):
            self._ones = 64 * np.arange(1, len(self.zeros) + 1) - self.zeros
        word = np.searchsorted(self._ones, index, side="right")
        before = np.where(word > 0, self._ones[np.maximum(word, 1) - 1], 0)
        place = word * 64 + _nth(self.upper[word], (index - before).astype(np.uint64))
        return (place - index).astype(np.uint64) << np.uint64(self.width) | self._low(index)

    def _low(self, index: np.ndarray) -> np.ndarray:
        width = np.uint64(self.width)
        bit = index.astype(np.uint64) * width
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        value = self.low[word] >> shift
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), 0)
        return (value | rest.astype(np.uint64)) & np.uint64((1 << self.width) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the sequence; -1 if it is not there."""
        result = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return result
        high = (keys >> np.uint64(self.width)).astype(np.int64)
        open_ = np.flatnonzero((high >= 0) & (high < self.buckets))
        high = high[open_]
        # a bucket's members follow the zero that ends the bucket before
        place = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0)
        start = place - high
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        following = self.upper[np.minimum(word + 1, len(self.upper) - 1)]
        run = self.upper[word] >> shift | following << (np.uint64(63) - shift) << _one
        size = np.bitwise_count((run ^ run + _one) >> _one).astype(np.int64)
        long = np.flatnonzero(size >= 63)
        if len(long):
            size[long] = self._zero(high[long]) - place[long]
        stop = start + size
        some = stop > start
        open_, start, stop = open_[some], start[some], stop[some]
        if self.width == 0:
            result[open_] = start
            return result
        wanted = keys[open_] & np.uint64((1 << self.width) - 1)
        first, last = start.copy(), stop.copy()
        busy = np.arange(len(open_))
        while len(busy):  # the successor of the wanted low bits within the bucket
            middle = (first[busy] + last[busy]) >> 1
            less = self._low(middle) < wanted[busy]
            first[busy] = np.where(less, middle + 1, first[busy])
            last[busy] = np.where(less, last[busy], middle)
            busy = busy[first[busy] < last[busy]]
        inside = first < stop
        hit = inside.copy()
        hit[inside] = self._low(first[inside]) == wanted[inside]
        result[open_[hit]] = first[hit]
        return result
