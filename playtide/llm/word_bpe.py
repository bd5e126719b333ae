"""BPE encoding by speculation: propose tokens greedily, verify adjacent pairs, merge only what fails.

A word's BPE result is the only sequence of valid tokens in which no merge rule could have joined two
neighbours before either was complete. So a proposal is right exactly if every token is one that BPE itself
produces and every adjacent pair passes that test. Both are checked for all words of a batch with numpy;
words that fail are merged rule by rule.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, functions as F
from tokenizers import Tokenizer

from playtide.llm.common import WordMemo, byte_chars, give_back, kept_model, laid_out, slices, word_numbers

_NO_RULE = 1 << 40
_NEVER = np.int64(_NO_RULE)
_LONG = 64  # symbols of a word from which on it is proposed alone instead of in a matrix
_BASE = np.uint64(0x9E3779B97F4A7C15)
MEMO = 600_000  # words, and parts of words, that a worker remembers


class WordBpe:
    """The word-end BPE of a tokenizer file: NFC, lower case, white space dropped, ``</w>`` at word ends."""

    def __init__(self, path: str, remember: int = MEMO):
        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added = added
        self.added_pattern = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        size = max([*self.vocab.values(), *added.values()]) + 1
        self.names = [b""] * size
        for name, i in [*self.vocab.items(), *added.items()]:
            self.names[i] = name.encode()
        self.name_array = pa.array([n.decode() for n in self.names])
        self.byte_chars = byte_chars()
        self.symbol = [self.vocab[self.byte_chars[b]] for b in range(256)]
        self.last_symbol = [self.vocab[self.byte_chars[b] + self.suffix] for b in range(256)]
        self._merges([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]], size)
        self._table()
        self.split = regex.compile(self.words.pattern + "|\n")
        self.remember = remember
        self.forget()

    def forget(self) -> None:
        self.memo = WordMemo(self._encode_words, self.remember)
        self.parts = WordMemo(self._encode_parts, self.remember)

    # -- rules

    def _merges(self, merges: list[tuple[str, str]], size: int) -> None:
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)  # -1: a symbol, made by no rule
        self.rule: dict[int, int] = {}  # a pair of tokens to the rank of its rule
        self.made: list[int] = []  # by rank
        keys = np.empty(len(merges), np.int64)
        for r, (a, b) in enumerate(merges):
            a_id, b_id = self.vocab[a], self.vocab[b]
            made = self.vocab[a + b]
            keys[r] = a_id * size + b_id
            self.rule[a_id * size + b_id] = r
            self.made.append(made)
            if self.rank[made] < 0:  # the first rule that makes a token
                self.left[made], self.right[made], self.rank[made] = a_id, b_id, r
        self.size = size
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        # A token is valid if its two halves are and no earlier rule cuts across them.
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        whole = self.compatible(self.left[made], self.right[made], self.rank[made])
        self.valid = np.ones(size, bool)
        for token, good in zip(made.tolist(), whole.tolist(), strict=True):
            self.valid[token] = good and self.valid[self.left[token]] and self.valid[self.right[token]]

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair of adjacent tokens: does no rule (of a rank under ``before``) join across them?

        Both tokens are taken apart in the reverse order of their making. Two pieces that touch at the
        boundary at the same time would be joined if a rule for them comes before the rules that used
        them up; of equal rules the one further left comes first.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        end_x = np.full(len(x), _NEVER, np.int64) if before is None else before.astype(np.int64)
        end_y = end_x - 1 if before is not None else end_x.copy()
        good = np.ones(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            px, py = x[live], y[live]
            q = self._pair_rank(px, py)
            joined = (q < end_x[live]) & (q <= end_y[live])
            good[live[joined]] = False
            rx, ry = self.rank[px], self.rank[py]
            go = ~joined & ((rx >= 0) | (ry >= 0))
            live, rx, ry, px, py = live[go], rx[go], ry[go], px[go], py[go]
            first = rx > ry
            i, j = live[first], live[~first]
            end_x[i], x[i] = rx[first], self.right[px[first]]
            end_y[j], y[j] = ry[~first], self.left[py[~first]]
        return good

    # -- proposal

    def _table(self) -> None:
        """An open-addressed table from a polynomial hash of a token's symbols to its id."""
        back = {c: b for b, c in self.byte_chars.items()}
        rng = np.random.default_rng(7)
        self.code = rng.integers(1, 1 << 63, 257, dtype=np.uint64)  # 256: the word end
        self.longest = 1
        hashes, ids = [], []
        for name, i in self.vocab.items():
            ends = name.endswith(self.suffix) and len(name) > len(self.suffix)
            chars = name[: -len(self.suffix)] if ends else name
            if any(c not in back for c in chars):
                continue
            symbols = [back[c] for c in chars] + [256] * ends
            h = 0
            for s in symbols:
                h = (h * int(_BASE) + int(self.code[s])) & 0xFFFFFFFFFFFFFFFF
            hashes.append(h)
            ids.append(i)
            self.longest = max(self.longest, len(symbols))
        self.bits = 18
        slots = 1 << self.bits
        self.table_key = np.zeros(slots, np.uint64)
        self.table_id = np.full(slots, -1, np.int64)
        self.probes = 1
        for h, i in zip(hashes, ids, strict=True):
            at, n = (h * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits), 1
            while self.table_id[at] >= 0:
                at, n = (at + 1) % slots, n + 1
            self.table_key[at], self.table_id[at] = h, i
            self.probes = max(self.probes, n)
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)

    def _lookup(self, h: np.ndarray) -> np.ndarray:
        at = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.table_key[at] == h, self.table_id[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.table_id[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            hit = self.table_key[at[open_]] == h[open_]
            found[open_[hit]] = self.table_id[at[open_[hit]]]
            open_ = open_[~hit & (self.table_id[at[open_]] >= 0)]
        return found

    def _propose(self, words: list[bytes]) -> list[np.ndarray]:
        """Longest match from the left for words of about one length, all at once."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        width = int(n.max()) + 1
        symbols = np.zeros((len(words), width), np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        inside = np.arange(width)[None, :] < n[:, None]
        symbols[inside] = flat
        symbols[np.arange(len(words)), n] = 256
        coded = self.code[symbols]
        prefix = np.zeros((len(words), width + 1), np.uint64)
        for k in range(width):
            prefix[:, k + 1] = prefix[:, k] * _BASE + coded[:, k]
        pos = np.zeros(len(words), np.int64)
        total = n + 1
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        live = np.arange(len(words))
        while len(live):
            token = np.full(len(live), -1, np.int64)
            length = np.zeros(len(live), np.int64)
            for k in range(min(self.longest, int((total[live] - pos[live]).max())), 0, -1):
                end = pos[live] + k
                # A token ends before the last symbol or takes the word end with it.
                left = np.flatnonzero((token < 0) & (end <= total[live]) & (end != total[live] - 1))
                if not len(left):
                    continue
                rows, e = live[left], end[left]
                h = prefix[rows, e] - prefix[rows, e - k] * self.powers[k]
                got = self._lookup(h)
                hit = got >= 0
                token[left[hit]], length[left[hit]] = got[hit], k
            if (token < 0).any():
                raise ValueError("the vocabulary lacks a single byte")
            steps.append((live, token))
            pos[live] += length
            live = live[pos[live] < total[live]]
        rows = np.concatenate([r for r, _ in steps])
        tokens = np.concatenate([t for _, t in steps])
        order = np.argsort(rows, kind="stable")
        return np.split(tokens[order], np.cumsum(np.bincount(rows, minlength=len(words)))[:-1])

    # -- words

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: the rule of lowest rank first, of equal ones the leftmost."""
        ids = [*map(self.symbol.__getitem__, word[:-1]), self.last_symbol[word[-1]]]
        if len(ids) > _LONG:
            return self._merged_long(ids)
        get, size = self.rule.get, self.size
        ranks = [get(a * size + b, _NO_RULE) for a, b in zip(ids, ids[1:])]
        while ranks and (lowest := min(ranks)) < _NO_RULE:
            i = ranks.index(lowest)
            ids[i] = self.made[lowest]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + ids[i], _NO_RULE)
            if i < len(ranks):
                ranks[i] = get(ids[i] * size + ids[i + 1], _NO_RULE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words of any length."""
        get, size, end = self.rule.get, self.size, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a * size + b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue  # one of the two was used up before
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < end and (r := get(ids[x] * size + ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def speculate(self, words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """Proposals, and which of them are verified. No word may be empty."""
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            groups.setdefault(min(len(w).bit_length(), _LONG.bit_length()) if len(w) < _LONG else -i - 1, []).append(i)
        proposed: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
        for members in groups.values():
            for i, tokens in zip(members, self._propose([words[i] for i in members]), strict=True):
                proposed[i] = tokens
        if not words:
            return [], np.zeros(0, bool)
        tokens = np.concatenate(proposed)
        n = np.fromiter(map(len, proposed), np.int64, len(words))
        ends = np.cumsum(n)
        word_of = np.repeat(np.arange(len(words)), n)
        good = np.ones(len(words), bool)
        good[word_of[~self.valid[tokens]]] = False
        inner = np.ones(len(tokens), bool)
        inner[ends - 1] = False
        first = np.flatnonzero(inner)
        keys, back = np.unique(tokens[first] * self.size + tokens[first + 1], return_inverse=True)
        fine = self.compatible(keys // self.size, keys % self.size)
        good[word_of[first[~fine[back]]]] = False
        return proposed, good

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        proposed, good = self.speculate(parts)
        packed = np.concatenate(proposed).astype("<u4").tobytes() if parts else b""
        ends = (4 * np.cumsum([len(p) for p in proposed])).tolist()
        return [
            packed[start:end] if ok else struct.pack(f"<{len(ids := self.merged(word))}I", *ids)
            for word, start, end, ok in zip(parts, [0, *ends], ends, good.tolist())
        ]

    def _pieces(self, words: list[str]) -> list[list[bytes]]:
        """The parts of words, all cut at once: none has a line end, so these stand between them."""
        if not words:
            return []
        text = "\n".join(words)
        if text.isascii():
            text = text.lower()
        else:
            text = "\n".join([w.lower() if w.isascii() else self.library.normalizer.normalize_str(w) for w in words])
        out: list[list[bytes]] = [[]]
        for part in self.split.findall(text):
            if part == "\n":
                out.append([])
            else:
                out[-1].append(part.encode())
        return out

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words without ASCII white space inside, as little-endian 32-bit integers."""
        text = [w.decode() for w in words]
        special = [i for i, w in enumerate(text) if "<|" in w and self.added_pattern is not None and self.added_pattern.search(w)]
        held = {i: text[i] for i in special}
        for i in special:
            text[i] = ""
        cut: list[list] = self._pieces(text)
        for i, word in held.items():
            pieces, at = [], 0
            for m in self.added_pattern.finditer(word):
                pieces += [*self._pieces([word[at : m.start()]])[0], self.added[m.group()]]
                at = m.end()
            cut[i] = [*pieces, *self._pieces([word[at:]])[0]]
        known = self.parts.learn([[p for p in c if isinstance(p, bytes)] if i in held else c for i, c in enumerate(cut)])
        return [
            known[c[0]] if len(c) == 1 and i not in held
            else b"".join([known[p] if isinstance(p, bytes) else p.to_bytes(4, "little") for p in c])
            for i, c in enumerate(cut)
        ]

    # -- texts

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of whole texts. White space never reaches a token, so words are encoded one by one, each kind once."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        kinds, number = word_numbers(lists.flatten().cast(pa.binary()))
        known = self.memo.learn([[k for k in kinds if k]])
        packed = [known[k] if k else b"" for k in kinds]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        size = sizes[number]
        ids = laid_out(np.frombuffer(b"".join(packed), "<i4"), (np.cumsum(sizes) - sizes)[number], size)
        ends = np.cumsum(np.r_[0, size])[lists.offsets.to_numpy()]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens' names with a blank between, as the library gives them for a file without decoder."""
        names = self.name_array.take(ids.flatten())
        ends = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names), " ")


def tokenizer(path: str, remember: int = MEMO) -> WordBpe:
    return kept_model(("word_bpe", path, remember), lambda: WordBpe(path, remember))


def encode(text: Column, path: str, remember: int = MEMO) -> Column:
    """Token ids of each text as binary: little-endian unsigned 32-bit integers.

    A null or blank text gives an empty binary. Equal texts give equal ids; the order of rows and other
    columns play no part. Each word that is new to a task is proposed, verified and, if need be, merged once. With less
    than ``MEMO`` words to ``remember`` a worker also forgets them after each task: for jobs whose other stages need
    the memory.
    """

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path, remember)
        for texts in batches:
            yield pa.concat_arrays([_packed(bpe.encode(piece)) for piece in slices(texts)] or [pa.array([], pa.binary())])
        if remember < MEMO:
            bpe.forget()
        give_back(("word_bpe", path, remember))

    return run(text)


def _packed(lists: pa.ListArray) -> pa.Array:
    """Lists of 32-bit integers as the bytes that hold them."""
    ids = lists.flatten()
    ends = (4 * lists.offsets.to_numpy().astype(np.int64)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.to_numpy().tobytes())])


def _unpacked(ids: pa.Array) -> pa.ListArray:
    """The other way round; a null has none."""
    ends = np.cumsum(np.r_[0, pc.fill_null(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False)]) // 4
    flat = np.frombuffer(b"".join(x or b"" for x in ids.to_pylist()), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def round_trip(text: Column, path: str) -> Column:
    """Ids of each text and the text that these ids decode to, in one pass: struct of ``ids`` and ``decoded``."""

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for texts in batches:
            found = [bpe.encode(piece) for piece in slices(texts)]
            ids = [_packed(x) for x in found] or [pa.array([], pa.binary())]
            decoded = [bpe.decode(x) for x in found] or [pa.array([], pa.string())]
            yield pa.StructArray.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(decoded)], ["ids", "decoded"])
        give_back(("word_bpe", path, MEMO))

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The text of ids that :func:`encode` gave; a null is an empty text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for packed in batches:
            yield bpe.decode(_unpacked(packed))
        give_back(("word_bpe", path, MEMO))

    return run(ids)
