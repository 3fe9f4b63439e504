"""Hashes of words and of word shingles, the same in every task."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words whose hashes one Python worker remembers; then they are let go.
REMEMBERED = 400_000
FACTOR = 0x9E3779B97F4A7C15
_known: dict[str, int] = {}


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash for each word."""
    known, make = _known, xxhash.xxh3_64_intdigest
    found = []
    for word in words:
        value = known.get(word)
        if value is None:
            if len(known) >= REMEMBERED:
                known.clear()
            value = known[word] = make(word.encode("utf-8", "surrogatepass"))
        found.append(value)
    return np.array(found, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; different ones stay different."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(words: list[str], size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, sorted; of all words as one run if there are fewer."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes, size = word_hashes(words), min(size, len(words))
    return np.unique(_runs(hashes, size))


def _runs(hashes: np.ndarray, size: int) -> np.ndarray:
    count = len(hashes) - size + 1
    runs = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        runs = runs * np.uint64(FACTOR) + hashes[i : i + count]
    return mixed(runs)


# --- the same for whole columns of texts, without a look-up for each word ---

#: Bytes hashed together; longer texts are cut where a word ends.
BLOCK = 1 << 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _powers(factor: int) -> np.ndarray:
    powers = np.full(2 * BLOCK + 1, factor, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_POWERS, _INVERSE = _powers(FACTOR), _powers(pow(FACTOR, -1, 1 << 64))
_SOLID = np.array([not _SPACE.match(bytes([b])) for b in range(256)])
# A-Z count as a-z.
_VALUES = mixed(np.array([b + 1 for b in bytes(range(256)).lower()], dtype=np.uint64))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of at most ``2 * BLOCK`` bytes begin, and their hashes.

    A word's hash is a polynomial of its bytes: a difference of running sums, moved to the power 0.
    """
    given = np.frombuffer(data, dtype=np.uint8)
    solid = np.zeros(len(given) + 2, dtype=bool)
    solid[1:-1] = _SOLID[given]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(given) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[given] * _POWERS[: len(given)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(np.uint64))


def _long_word(word: bytes) -> int:
    """The same hash of a word of any length, block by block."""
    total = len(word)
    for begin in range(0, len(word), BLOCK):
        part = np.frombuffer(word[begin : begin + BLOCK], dtype=np.uint8)
        total += int((_VALUES[part] * _POWERS[: len(part)]).sum()) * pow(FACTOR, begin, 1 << 64)
    return int(mixed(np.array([total % (1 << 64)], dtype=np.uint64))[0])


def _long_text(data: bytes) -> np.ndarray:
    """Hashes of the words of a text of any length."""
    found, begin = [], 0
    while begin < len(data):
        space = _SPACE.search(data, begin + BLOCK)
        end = space.start() if space else len(data)
        part = data[begin:end]
        if len(part) <= 2 * BLOCK:
            found.append(_words(part)[1])
        else:
            found.append(np.array([_long_word(w) for w in part.split()], dtype=np.uint64))
        begin = end
    return np.concatenate(found)


def column_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text of a column, distinct hashes of the runs of ``size`` of its words, sorted; see ``shingles``.

    Words are what lies between the six ASCII blanks, with A-Z lower-cased. Short texts are hashed together.
    """
    held: list[bytes] = []
    room = BLOCK

    def out():
        starts, hashes = _words(b"\n".join(held))
        sizes = np.array([len(t) + 1 for t in held])
        bounds = np.searchsorted(starts, np.cumsum(sizes)).tolist()
        runs = _runs(hashes, size) if len(hashes) >= size else hashes[:0]
        begin = 0
        for end in bounds:
            yield _distinct(hashes[begin:end], runs[begin : max(begin, end - size + 1)], size)
            begin = end
        held.clear()

    for value in texts.cast(pa.binary()):
        text = value.as_py() or b""
        if held and len(text) >= room:
            yield from out()
            room = BLOCK
        if len(text) >= BLOCK:
            hashes = _long_text(text)
            yield _distinct(hashes, _runs(hashes, size) if len(hashes) >= size else hashes[:0], size)
        else:
            held.append(text)
            room -= len(text) + 1
    if held:
        yield from out()


def _distinct(hashes: np.ndarray, runs: np.ndarray, size: int) -> np.ndarray:
    if len(hashes) < size:
        return _runs(hashes, len(hashes)) if len(hashes) else hashes
    runs = np.sort(runs)
    new = np.ones(len(runs), dtype=bool)
    np.not_equal(runs[1:], runs[:-1], out=new[1:])
    return runs[new]
