"""Small helpers the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

#: Bytes of text that are held as Python objects at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in consecutive pieces of about ``limit`` bytes, one row at least in each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(sizes + 16) // limit  # 16: many empty texts make a slice as well
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]) if len(texts) else []
    for start, end in zip(starts, [*starts[1:], len(texts)], strict=True):
        yield texts.slice(start, end - start)


_MODEL: dict = {}


def kept_model(key: tuple, build: Callable):
    """The model of the operator that a Python worker serves, kept for its next tasks.

    A worker holds one model: it lives on and serves stages of several operators, whose models would add up. A running
    task holds its own.
    """
    if key not in _MODEL:
        give_back()
        _MODEL[key] = build()
    return _MODEL[key]


def give_back(key: tuple | None = None) -> None:
    """Let go of all kept models but the one of ``key``, and return freed memory to the system."""
    for other in [k for k in _MODEL if k != key]:
        del _MODEL[other]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null is empty."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def as_strings(texts: pa.Array) -> list[str]:
    """Each text; a null is empty."""
    return [x or "" for x in texts.to_pylist()]


class WordMemo:
    """What a function gives for words, kept for about ``limit`` words, of 40 bytes on average, between batches.

    ``compute`` takes a list of unseen words and returns one value for each. The bounds only limit what is remembered:
    when one is reached, words that were not met again since the last time are dropped and computed again if need be.
    """

    def __init__(self, compute: Callable[[list], Sequence], limit: int = 150_000):
        self.compute, self.limit, self.most, self.size, self.known, self.met = compute, limit, 40 * limit, 0, {}, set()

    def learn(self, documents: Sequence[Sequence]) -> dict:
        """A mapping that has every word of these documents."""
        words = set().union(*documents)
        unseen = words.difference(self.known)
        self.met |= words.difference(unseen)
        grown = sum(map(len, unseen))
        if len(self.known) + len(unseen) > self.limit or self.size + grown > self.most:
            few = len(self.met) < self.limit // 2 and sum(map(len, self.met)) < self.most // 2
            kept = self.met if few else words.difference(unseen)
            self.known = {w: self.known[w] for w in kept}
            self.met, self.size = set(), sum(map(len, self.known))
        if unseen:
            unseen = list(unseen)
            self.known.update(zip(unseen, self.compute(unseen), strict=True))
            self.size += grown
        return self.known


def laid_out(source: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces of ``source`` that begin at ``start`` and have ``size`` numbers, one after the other."""
    before = np.cumsum(size) - size
    return source[np.repeat(start - before, size) + np.arange(int(size.sum()))]


def word_numbers(words: pa.Array) -> tuple[list, np.ndarray]:
    """The different words of an array, and for each of its words the number of its kind."""
    coded = words.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and what follows."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted({*range(256)}.difference(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers, so that nearby values are far apart."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_filter(hashes: DataFrame, column: str, least_bits: int, most_bits: int) -> np.ndarray:
    """A bitmap over a column of 64-bit hashes; a bit that is not set rules a hash out.

    It has 16 bits for each row or more, up to ``2 ** most_bits`` in all: beyond that it grows no further and only
    rules less out. At most that many bits come to the driver.
    """
    bits = min(max(least_bits, (16 * hashes.count()).bit_length()), most_bits)
    slots = hashes.select(F.pmod(column, F.lit(1 << bits)).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    out = np.zeros(1 << bits - 6, np.int64)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def may_have(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of these (signed or unsigned) 64-bit hashes the bitmap does not rule out."""
    slot = hashes.view(np.uint64) & np.uint64(64 * len(bitmap) - 1)
    return ((bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
