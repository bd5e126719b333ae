"""Byte-level BPE as a tree reduction: halves are encoded on their own and joined by the boundary between them.

Merging always takes the pair of lowest rank, of equal ones the leftmost. Until some merge crosses a given boundary,
what happens on one side does not depend on the other. So a sequence of tokens is what merging gives exactly if each
two neighbours, merged alone from their bytes, come out as the same two tokens. Joining two encoded halves therefore
needs to look at the boundary only: a window of tokens around it is merged again from its bytes, and grows until both
of its edges pass that test against the tokens outside. Joining is associative, with the empty sequence as its unit.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F

from playtide.llm.common import as_bytes, give_back, kept_model, slices

Tokens = tuple[int, ...]
_NO_RANK = 1 << 40
_LONG = 48  # bytes from which on a window is merged with a heap
#: Bytes of words, matches, short halves and windows that a worker remembers, each; an entry counts its text and ``_ENTRY`` bytes more.
REMEMBERED = 48 << 20
_ENTRY = 64
_LEAF = 256  # tokens that decoding joins at once
_SHORT = 8  # bytes up to which a half is remembered

#: White space other than blanks and line ends, or its first bytes, and blanks next to white space.
_ODD_ASCII = b"\t\v\f\r\x1c\x1d\x1e\x1f"
_ODD = (b"  ", b" \n", b"\n ", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")


def pack(ids: Tokens) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def single_blanks(text: bytes) -> bool:
    """Does each blank of the text stand alone between two characters that are no white space?"""
    if text[:1] == b" " or text[-1:] == b" " or len(text.translate(None, _ODD_ASCII)) != len(text):
        return False
    return not any(x in text for x in _ODD)


def reduced(parts: Sequence, join: Callable, unit):
    """All parts joined in order, neighbours first: a balanced tree of joins, ``unit`` for no part."""
    level = list(parts)
    while len(level) > 1:
        odd = level[-1:] if len(level) % 2 else []
        level = [join(a, b) for a, b in zip(level[::2], level[1::2])] + odd
    return level[0] if level else unit


class Memo:
    """Results by key. When their keys' bytes pass the bound, all are forgotten and computed again if need be."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.held, self.known = limit, 0, {}

    def add(self, key, value) -> None:
        self.held += _ENTRY + len(key)
        self.known[key] = value

    def add_all(self, found: dict) -> None:
        self.held += _ENTRY * len(found) + sum(map(len, found))
        self.known.update(found)

    def make_room(self) -> None:
        if self.held > self.limit:
            self.known, self.held = {}, 0


class TreeBpe:
    """Encoding and decoding by the ranks of a file, each match of ``pattern`` separately, without special tokens."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks: dict[bytes, int] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        # Words are cut at blanks before the pattern sees them only where it is known to treat them alike.
        self.by_words = pattern == public_tokenizers.PATTERN
        self.names: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for name, i in self.ranks.items():
            self.names[i] = name
        self.windows, self.halves, self.matches, self.words = Memo(), Memo(), Memo(), Memo()

    # -- exact merging of a window

    def merged(self, text: bytes) -> Tokens:
        """Tokens of a window by merging its bytes."""
        known = self.windows.known.get(text)
        if known is None:
            known = self._merged(text) if len(text) < _LONG else self._merged_long(text)
            self.windows.add(text, known)
        return known

    def _merged(self, text: bytes) -> Tokens:
        get = self.ranks.get
        cuts = [*range(len(text) + 1)]
        found = [get(text[i : i + 2], _NO_RANK) for i in range(len(text) - 1)]
        while found and (lowest := min(found)) < _NO_RANK:
            i = found.index(lowest)
            del cuts[i + 1], found[i]
            if i:
                found[i - 1] = get(text[cuts[i - 1] : cuts[i + 1]], _NO_RANK)
            if i < len(found):
                found[i] = get(text[cuts[i] : cuts[i + 2]], _NO_RANK)
        return tuple([self.ranks[text[a:b]] for a, b in zip(cuts, cuts[1:])])

    def _merged_long(self, text: bytes) -> Tokens:
        """The same with a heap, for windows of any length."""
        get, size = self.ranks.get, len(text)
        end, start = list(range(1, size + 1)), list(range(-1, size - 1))  # of the piece at i; where the one before it begins
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := get(text[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j < 0 or j >= size or end[j] != stop:
                continue  # one of the two pieces was used up before
            end[i], end[j] = stop, -1
            if stop < size:
                start[stop] = i
                if (r := get(text[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := get(text[start[i] : stop])) is not None:
                heapq.heappush(heap, (r, start[i], stop))
        return tuple([self.ranks[text[i:e]] for i, e in enumerate(end) if e > 0])

    # -- the tree

    def stable(self, a: int, b: int) -> bool:
        """Do two neighbours come out as themselves when merged alone?"""
        return self.merged(self.names[a] + self.names[b]) == (a, b)

    def join(self, left: Tokens, right: Tokens) -> Tokens:
        """The tokens of two neighbouring texts put together."""
        if not left or not right:
            return left or right
        names, a, b = self.names, left[-1], right[0]
        middle = self.merged(names[a] + names[b])
        if middle == (a, b):
            return left + right  # nothing moves, and all other neighbours are as they were
        before = after = 1
        while True:
            left_holds = before >= len(left) or self.stable(left[-before - 1], middle[0])
            right_holds = after >= len(right) or self.stable(middle[-1], right[after])
            if left_holds and right_holds:
                return left[:-before] + middle + right[after:]
            before, after = before * (2 - left_holds), after * (2 - right_holds)
            middle = self.merged(b"".join([names[t] for t in left[-before:]] + [names[t] for t in right[:after]]))

    def tree(self, text: bytes) -> Tokens:
        """Tokens of one match by halves."""
        known = self.halves.known.get(text)
        if known is not None:
            return known
        if len(text) < 2:
            return (self.ranks[text],) if text else ()
        token = self.ranks.get(text)
        if token is not None and self.merged(text) == (token,):
            found: Tokens = (token,)
        else:
            half = len(text) // 2
            found = self.join(self.tree(text[:half]), self.tree(text[half:]))
        if len(text) <= _SHORT:
            self.halves.add(text, found)
        return found

    def match(self, text: bytes) -> Tokens:
        """A match that is in the file as a whole is that token, also where merging would not make it."""
        token = self.ranks.get(text)
        return self.tree(text) if token is None else (token,)

    # -- texts

    def _packed(self, matches: list[str]) -> list[bytes]:
        """Ids of matches, as little-endian 32-bit integers; they are joined between matches as they are."""
        known = self.matches.known
        new = {m: pack(self.match(m.encode())) for m in set(matches).difference(known)}
        self.matches.add_all(new)
        return [*map(known.__getitem__, matches)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words with the blank before them; no word is empty or holds white space but single line ends."""
        if not words:
            return {}
        found = self.pattern.findall(" " + " ".join(words))
        ids = self._packed(found)
        starts = [k for k, m in enumerate(found) if m[0] == " "]
        ends = [*starts[1:], len(found)]
        return {w: b"".join(ids[a:b]) for w, a, b in zip(words, starts, ends, strict=True)}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts.

        The pattern never joins the character before a single blank between words with it, so texts are cut there and
        each different word is looked at once. Texts with other white space go through the pattern as a whole.
        """
        for memo in (self.windows, self.halves, self.matches, self.words):
            memo.make_room()
        split = [t.decode().split(" ") if self.by_words and single_blanks(t) else None for t in texts]
        known = self.words.known
        new = set().union(*[s[1:] for s in split if s]).difference(known)
        self.words.add_all(self._words(list(new)))
        out = []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                out.append(b"".join(self._packed(self.pattern.findall(text.decode()))))
            else:
                head = b"".join(self._packed(self.pattern.findall(words[0])))
                out.append(head + b"".join(map(known.__getitem__, words[1:])))
        return out

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of tokens, joined up the tree."""
        name = self.names.__getitem__
        leaves = [b"".join(map(name, ids[k : k + _LEAF])) for k in range(0, len(ids), _LEAF)]
        return reduced(leaves, bytes.__add__, b"")


def tokenizer(path: str) -> TreeBpe:
    return kept_model(("tree_bpe", path), lambda: TreeBpe(path))


def _ids(packed: list[bytes]) -> pa.Array:
    """A list of ids for each text."""
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode(text: Column, path: str) -> Column:
    """Token ids of each text, an array of integers.

    A null or empty text gives an empty array. Equal texts give equal ids; other columns and the order of rows play no
    part. A text is one value of a row; what a worker remembers is bounded in bytes.
    """

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for texts in batches:
            yield _ids([ids for piece in slices(texts) for ids in bpe.encode(as_bytes(piece))])
        give_back(("tree_bpe", path))

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes of ids that :func:`encode` gave; a null is empty."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for lists in batches:
            yield pa.array([bpe.decode(x or []) for x in lists.to_pylist()], pa.binary())
        give_back(("tree_bpe", path))

    return run(ids)


def round_trip(text: Column, path: str) -> Column:
    """Ids of each text and the bytes that these ids decode to, in one pass: struct of ``ids`` and ``decoded``."""

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for texts in batches:
            packed, decoded = [], []
            for piece in slices(texts):
                found = bpe.encode(as_bytes(piece))
                packed += found
                decoded += [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in found]
            yield pa.StructArray.from_arrays([_ids(packed), pa.array(decoded, pa.binary())], ["ids", "decoded"])
        give_back(("tree_bpe", path))

    return run(text)
