r"""Hashes of the words ``[^\x20\x09-\x0D]+`` of many texts at once, A-Z in lower case.

Works on UTF-8 bytes: the white space and the letters concerned are ASCII, so the bytes of
other characters pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_blank = np.zeros(256, bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_value = np.where(_blank, 0, _lower.astype(np.uint64) + 1).astype(np.uint64)
_BASE = np.uint64(0x9E6C63D0876A9A47)
_powers = np.ones(1, np.uint64)

#: Bytes of text hashed together; a longer text is hashed by itself.
BLOCK_BYTES = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers(longest: int) -> np.ndarray:
    global _powers
    if len(_powers) < longest:
        size = max(256, 1 << (longest - 1).bit_length())
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the place of each text's first word (one more
    at the end)."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends, bounds = located(data, texts)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    return hashed(data, starts, ends), bounds


def located(data: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of the joined texts start and end, and each text's first word."""
    inside = ~_blank[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return starts, ends, np.searchsorted(starts, offsets)


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    place = _places(starts, len(data))
    table = powers(int(lengths.max()))
    parts = _value[data]
    parts *= table[np.minimum(place, len(table) - 1)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(parts, out=sums[1:])
    return mix(sums[ends] - sums[starts] + lengths.astype(np.uint64))


def _places(starts: np.ndarray, size: int) -> np.ndarray:
    """Distance of each byte from the start of its word; 0 before the first word."""
    first = np.zeros(size, np.int64)
    first[starts] = np.diff(starts, prepend=0)
    place = np.arange(size) - np.cumsum(first)
    place[: starts[0]] = 0
    return place


def in_blocks(
    texts: list[bytes], most: int = BLOCK_BYTES
) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about ``most`` bytes, with the place of each group's first text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > most:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]
