"""Benchmark passages inside documents, by the CGK random-walk embedding and bit-sampling LSH.

The embedding reads a word sequence with a pointer that a random function of (step, word) holds or moves on, and
writes the word under the pointer at each step. Sequences of edit distance k get outputs of Hamming distance
O(k * k) with constant probability, so sampled output positions agree often for near sequences. Each repetition
is a walk with its own random function, of which several samples are taken; an equal sample makes a candidate, which an
exact edit distance confirms. Items so long that too many walks would be needed are found by the count filter alone.

Windows start at every word of a document where the exact count filter allows one: a window within k edits of an
item of n words has all but k * g of the item's g-grams.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from playtide.llm.common import WordMemo, as_bytes, give_back, hash_filter, may_have, mixed, slices
from playtide.llm.ngram_join import staged

#: An item of n words is found within floor(n * EDITS) word edits; the chance to find one at that distance is RECALL
#: at least, and nearer ones are found more surely. Exact copies always are.
EDITS, RECALL = 0.15, 0.95
GRAM = 3
SAMPLED = 3  # output positions that make a key
KEYS = 4  # keys that are taken from one walk
#: Window lengths in words: an item is embedded in windows of the largest length that is not over its own.
LENGTHS = tuple(dict.fromkeys(int(1.25**k) for k in range(60)))
#: Bits of the filters of the items' grams and keys; more items only let more windows through.
TABLE_BITS = (20, 25)
#: Items that would need more walks go through the exact count filter instead, and so do those of longer windows, for
#: which planning would take the driver minutes.
MOST_REPEATS, LONGEST_PLANNED = 64, 350
NEAR = 16
_CELLS = 1 << 20  # numbers of the edit distances that are held at once


def length_class(n: int) -> int:
    return max(x for x in LENGTHS if x <= n)


def edits_allowed(n: int, edits: float = EDITS) -> int:
    """Word edits for an item of n words: as many as leave it one of its own g-grams at least."""
    k = int(n * edits)
    while k and n - GRAM + 1 <= k * GRAM:
        k -= 1
    return k


def _coin(words: np.ndarray, step: int, repeat: int) -> np.ndarray:
    """The random function of the walk: does the pointer move on?"""
    seed = np.uint64((repeat * 0x9E3779B97F4A7C15 + step * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    return (mixed(words ^ seed) & np.uint64(1)).astype(np.int64)


@lru_cache(maxsize=None)
def _positions(length: int, repeat: int) -> tuple[tuple[int, ...], ...]:
    """Output positions that each key of a repetition samples: of the 3n steps, those a walk of n words sure reaches
    before its end."""
    rng = np.random.default_rng([length, repeat])
    reach = max(1, length)
    return tuple(tuple(sorted(rng.choice(reach, min(SAMPLED, reach), replace=False).tolist())) for _ in range(KEYS))


def keys(windows: np.ndarray, repeat: int) -> np.ndarray:
    """The sampled outputs of each row of word hashes (rows of one length) in one repetition: a row of 64-bit keys for
    each of the ``KEYS`` samples."""
    length = windows.shape[1]
    rows, at = np.arange(len(windows)), np.zeros(len(windows), np.int64)
    sampled = _positions(length, repeat)
    out = np.empty((KEYS, len(windows)), np.uint64)
    for k in range(KEYS):
        out[k] = np.uint64((length * 1000 + repeat) * KEYS + k)
    for step in range(max(s[-1] for s in sampled) + 1):
        word = windows[rows, np.minimum(at, length - 1)]
        word[at >= length] = 0
        for k, steps in enumerate(sampled):
            if step in steps:
                out[k] = mixed(out[k] ^ word + np.uint64(step))
        at += _coin(word, step, repeat)
    return out


def _edited(rng: np.random.Generator, words: list[int], edits: int) -> list[int]:
    """The words after that many replaced, inserted or dropped words, at any place."""
    words = list(words)
    for _ in range(edits):
        where, kind = int(rng.integers(len(words) + 1)), int(rng.integers(3))
        words[where : where + (kind != 1)] = [int(rng.integers(1, 1 << 62))] * (kind != 2)
    return words


def _pair_repeats(n: int, k: int, wanted: float, trials: int) -> int | None:
    """The fewest repetitions that find the wanted share of random items of n words, each in a text with k edits; None if
    ``MOST_REPEATS`` do not.

    A pair is found by any of the windows near its place that the count filter lets through, in any repetition; windows
    further than ``NEAR`` words off are left out here, which can only ask for more repetitions.
    """
    length, rng = length_class(n), np.random.default_rng([n, k])
    g = min(GRAM, n)
    span, least = n + k, max(1, n - g + 1 - g * k)
    first = rng.integers(1, 1 << 62, (trials, n)).astype(np.uint64)
    windows, owner = [], []
    for row in range(trials):
        text = np.array([*rng.integers(1, 1 << 62, k).tolist(), *_edited(rng, first[row].tolist(), k),
                         *rng.integers(1, 1 << 62, span + n).tolist()], np.uint64)
        known = np.cumsum(np.r_[0, np.isin(_grams(text, g), _grams(first[row], g))])
        starts = np.array([s for s in range(max(0, k - NEAR), k + min(k, NEAR) + 1) if known[min(s + span - g + 1, len(known) - 1)] - known[s] >= least], np.int64)
        windows.append(text[starts[:, None] + np.arange(length)[None, :]])
        owner.append(np.full(len(starts), row))
    near, owner = np.concatenate(windows), np.concatenate(owner)
    lost = np.ones(trials, bool)
    times = 0
    while lost.mean() > 1 - wanted:
        if times == MOST_REPEATS:
            return None
        mine = keys(first[:, :length], times)
        lost[owner[(keys(near, times) == mine[:, owner]).any(axis=0)]] = False
        left = lost[owner]  # what is found needs no more repetitions
        near, owner, times = near[left], owner[left], times + 1
    return max(1, times)


@lru_cache(maxsize=None)
def repeats(length: int, edits: float = EDITS, recall: float = RECALL) -> int | None:
    """Repetitions that find an item of a window length at the largest distance allowed with the wanted probability, or
    None where that takes more than ``MOST_REPEATS`` or the window is longer than ``LONGEST_PLANNED``.

    Repetitions of one pair are not independent, so what is measured is the share of random pairs that any of them
    finds, over all word counts of this window length whose distance is larger than that of the count before. The
    share has to be over the recall by twice its standard error.
    """
    if length > LONGEST_PLANNED:
        return None
    longest = next((x for x in LENGTHS if x > length), length + 1) - 1
    hardest: dict[int, int] = {}
    for n in range(length, longest + 1):
        hardest.setdefault(edits_allowed(n, edits), n)
    trials = 2000 if length <= 100 else 500
    wanted = min(recall + 2 * math.sqrt(recall * (1 - recall) / trials), 1 - 1 / trials)
    most = 1
    for k, n in sorted(hardest.items(), reverse=True):
        found = _pair_repeats(n, k, wanted, trials) if k else 1
        if found is None:
            return None
        most = max(most, found)
    return most


class Words:
    """Lower-cased words of texts as 64-bit hashes."""

    def __init__(self):
        self.memo = WordMemo(lambda words: [xxhash.xxh64_intdigest(w) for w in words])

    def hashed(self, texts: list[bytes]) -> tuple[list[list[bytes]], list[np.ndarray]]:
        split = [t.lower().split() for t in texts]
        known = self.memo.learn(split)
        return split, [np.fromiter(map(known.__getitem__, w), np.uint64, len(w)) for w in split]


def _grams(words: np.ndarray, g: int) -> np.ndarray:
    key = np.zeros(max(0, len(words) - g + 1), np.uint64)
    for k in range(g):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(key)]
    return mixed(key ^ np.uint64(g))


def edit_matches(item: np.ndarray, windows: list[np.ndarray]) -> list[tuple[int, int, int]]:
    """(edits, start, end) for each window: its part nearest to the item, and the word edits between them.

    Of equally near parts the one that ends first, then the one that starts last. Words are numbers. All windows
    go through the rows of the distance table together; a cell is its edits times ``base`` less its start, so that the
    least cell has the fewest edits and of these the last start.
    """
    sizes = np.fromiter(map(len, windows), np.int64, len(windows))
    width = int(sizes.max(initial=0))
    base = width + 1
    words = np.full((len(windows), width), -1, np.int64)
    inside = np.arange(width)[None, :] < sizes[:, None]
    words[inside] = np.concatenate(windows) if len(windows) else words[inside]
    place = np.arange(width + 1, dtype=np.int64)
    row = np.broadcast_to(-place, (len(windows), width + 1)).copy()
    for i, word in enumerate(item, 1):
        cell = np.empty_like(row)
        cell[:, 0] = i * base
        np.minimum(row[:, :-1] + np.where(words == word, 0, base), row[:, 1:] + base, out=cell[:, 1:])
        # A cell may also come from the one before it in its row, for one more edit.
        row = np.minimum.accumulate(cell - place * base, axis=1) + place * base
    row[place[None, :] > sizes[:, None]] = np.iinfo(np.int64).max
    end = row.argmin(axis=1)
    least = row[np.arange(len(windows)), end]
    edits = (least + base - 1) // base
    return list(zip(edits.tolist(), (edits * base - least).tolist(), end.tolist()))


def edit_match(item: list, window: list) -> tuple[int, int, int]:
    """The same for one window, of words of any kind."""
    number: dict = {}
    first, second = (np.array([number.setdefault(w, len(number)) for w in x], np.int64) for x in (item, window))
    return edit_matches(first, [second])[0]


_ITEMS = "item_id long, item string, words int, length int, gram int, grams array<long>, hashes array<long>"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items to their words, window length and grams."""
    kind = pa.schema([("item_id", pa.int64()), ("item", pa.string()), ("words", pa.int32()), ("length", pa.int32()),
                      ("gram", pa.int32()), ("grams", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64()))])
    words = Words()
    for batch in batches:
        out = []
        split, hashed = words.hashed(as_bytes(batch.column("text")))
        for item_id, raw, h in zip(batch.column("item_id").to_pylist(), split, hashed, strict=True):
            if raw:
                g = min(GRAM, len(raw))
                out.append({"item_id": item_id, "item": b" ".join(raw).decode(), "words": len(raw),
                            "length": length_class(len(raw)), "gram": g,
                            "grams": np.unique(_grams(h, g)).view(np.int64).tolist(), "hashes": h.view(np.int64).tolist()})
        yield pa.RecordBatch.from_pylist(out, schema=kind)


def _item_keys(times: dict[int, int]):
    kind = pa.schema([("item_id", pa.int64()), ("item", pa.string()), ("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                window = np.array(row["hashes"], np.int64).view(np.uint64)[None, : row["length"]]
                for r in range(times[row["length"]]):
                    for key in keys(window, r).view(np.int64)[:, 0].tolist():
                        out.append({"item_id": row["item_id"], "item": row["item"], "key": key})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return run


_WINDOWS = "doc_id long, text_hash long, start int, part string, key long, grams array<long>"


def _windows(grams, sought, plan: list[tuple[int, int, int, int, int | None]]):
    """Texts to the windows whose key an item may have.

    ``plan``: for each window length its gram size, the fewest items' grams a match of it has, the most words a match
    spans, and the repetitions. Without repetitions a stretch of windows that pass the count filter is given as a whole,
    with the items' grams in it instead of a key. ``grams`` and ``sought`` are bitmaps of the items' grams and keys.
    """
    kind = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("part", pa.string()), ("key", pa.int64()),
                      ("grams", pa.list_(pa.int64()))])
    gap = max((span for _, _, _, span, _ in plan), default=1) + GRAM
    bitmaps: list[np.ndarray] = []

    def found(raw: list[list[bytes]], hashed: list[np.ndarray], at: int) -> list[tuple]:
        # All texts in one array with a gap of zeros after each, so that no window runs into the next text.
        sizes = np.fromiter(map(len, hashed), np.int64, len(hashed))
        begins = np.cumsum(np.r_[0, sizes + gap])
        flat = np.zeros(begins[-1], np.uint64)
        for begin, h in zip(begins.tolist(), hashed):
            flat[begin : begin + len(h)] = h
        made = {g: _grams(flat, g) for g in {g for _, g, _, _, _ in plan}}
        hits = {g: may_have(bitmaps[0], x) for g, x in made.items()}
        known = {g: np.cumsum(np.r_[0, x], dtype=np.int32) for g, x in hits.items()}
        out: list[tuple] = []

        def add(start: int, length: int, key: int | None, of_items: list[int] | None) -> None:
            row = int(np.searchsorted(begins, start, side="right")) - 1
            first = start - int(begins[row])
            out.append((at + row, first, b" ".join(raw[row][first : first + length]), key, of_items))

        for n, g, least, span, times in plan:
            total, reach = known[g], span - g + 1
            starts = np.flatnonzero(total[reach:] - total[:-reach] >= least)
            starts = starts[flat[starts] != 0]
            if not len(starts):
                continue
            if times is None:
                row = np.searchsorted(begins, starts, side="right")
                new = np.flatnonzero(np.r_[True, (np.diff(starts) > span) | (np.diff(row) > 0)])
                for a, b in zip(new.tolist(), [*new[1:].tolist(), len(starts)]):
                    first, stop = int(starts[a]), int(starts[b - 1]) + span
                    add(first, stop - first, None, np.unique(made[g][first:stop][hits[g][first:stop]]).view(np.int64).tolist())
                continue
            step = max(1, _CELLS // n)
            for k in range(0, len(starts), step):
                some = starts[k : k + step]
                windows = flat[some[:, None] + np.arange(n)[None, :]]
                for r in range(times):
                    for key in keys(windows, r):
                        for i in np.flatnonzero(may_have(bitmaps[1], key)).tolist():
                            start = int(some[i])
                            low = max(start - span // 4, int(begins[np.searchsorted(begins, start, side="right") - 1]))
                            add(low, start + span - low, int(key[i : i + 1].view(np.int64)[0]), None)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        bitmaps[:] = [grams.value, sought.value]
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                rows = found(*words.hashed(as_bytes(texts)), at)
                at += len(texts)
                take, start, part, key, of_items = zip(*rows) if rows else ((), (), (), (), ())
                take = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(take), batch.column("text_hash").take(take), pa.array(start, pa.int32()),
                    pa.array([p.decode() for p in part], pa.string()), pa.array(key, pa.int64()), pa.array(of_items, pa.list_(pa.int64()))], schema=kind)
        del words
        bitmaps.clear()
        give_back()

    return run


def _confirm(edits: float):
    kind = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()),
                      ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            by_item: dict[str, list[int]] = {}
            for i, row in enumerate(rows):
                by_item.setdefault(row["item"], []).append(i)
            out = []
            for text, of_item in by_item.items():
                number: dict[str, int] = {}
                item = np.array([number.setdefault(w, len(number)) for w in text.split(" ")], np.int64)
                # Words that the item lacks are all the same to it.
                parts = [np.array([number.get(w, -1) for w in rows[i]["part"].split(" ")], np.int64) for i in of_item]
                order = sorted(range(len(parts)), key=lambda k: len(parts[k]))
                at = 0
                while at < len(order):
                    stop = at + 1
                    while stop < len(order) and (stop + 1 - at) * (len(parts[order[stop]]) + 1) <= _CELLS:
                        stop += 1
                    for k, (cost, start, end) in zip(order[at:stop], edit_matches(item, [parts[k] for k in order[at:stop]]), strict=True):
                        if cost <= edits_allowed(len(item), edits):
                            row = rows[of_item[k]]
                            out.append({"doc_id": row["doc_id"], "text_hash": row["text_hash"], "item_id": row["item_id"],
                                        "edits": cost, "start": row["start"] + start, "end": row["start"] + end})
                    at = stop
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return run


def _by_grams(windows: DataFrame, items: DataFrame, edits: float) -> DataFrame:
    """The stretches and items that share as many grams as a match has: no match is lost, whatever its edits."""
    parts = windows.where("grams is not null").withColumn("row", F.struct("doc_id", "text_hash", "start"))
    allowed = F.udf(lambda n: edits_allowed(n, edits), "int")("words")  # one call for each item
    of_item = items.withColumn("least", F.greatest(F.lit(1), F.size("grams") - F.col("gram") * allowed))
    shared = parts.select("row", F.explode("grams").alias("shared")).join(
        of_item.select("item_id", "item", "least", F.explode("grams").alias("shared")), "shared")
    # Equal items of one id count their grams once each.
    enough = shared.groupBy("row", "item_id", "item").agg(F.countDistinct("shared").alias("n"), F.first("least").alias("least")).where("n >= least")
    return enough.select("row", "item_id", "item").join(parts.select("row", "part").distinct(), "row").select(
        "row.doc_id", "row.text_hash", "item_id", "row.start", "part", "item")


def matches(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """(doc_id, text_hash, item_id, edits, start, end) of each item found in a document, at its nearest place.

    Words are parted by ASCII white space and compared without the case of A-Z; start and end count words. A null or
    blank text has none, a blank item is not searched, and an item shorter than three words or too short for an edit
    is found unchanged. Documents with equal ids and different texts are told apart by ``text_hash``; equal rows give
    one match. Equal items each give theirs. Other columns are not read.
    """
    spark = docs.sparkSession
    known = staged(items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_items, _ITEMS), "items")
    bounds = known.groupBy("length", "gram").agg(F.min("words"), F.max("words")).orderBy("length", "gram").collect()
    plan = []
    for n, g, low, high in bounds:  # one row for each window length: their number is fixed
        least = min(w - g + 1 - g * edits_allowed(w, edits) for w in range(low, high + 1))
        plan.append((n, g, max(1, least), high + edits_allowed(high, edits), repeats(n, edits, recall)))
    times = {n: most or 0 for n, _, _, _, most in plan}
    sought = known.select("item_id", "item", "length", "hashes").mapInArrow(_item_keys(times), "item_id long, item string, key long")
    spread = spark.sparkContext.broadcast
    grams = spread(hash_filter(known.select(F.explode("grams").alias("gram")), "gram", *TABLE_BITS))
    wanted = spread(hash_filter(sought, "key", *TABLE_BITS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    windows = rows.mapInArrow(_windows(grams, wanted, plan), _WINDOWS)
    whole = [n for n, _, _, _, most in plan if most is None]
    if whole:
        windows = staged(windows, "windows")  # they are read for both kinds of items
    near = windows.where("key is not null").drop("grams").join(sought, "key").groupBy("doc_id", "text_hash", "item_id", "start").agg(
        F.first("part").alias("part"), F.first("item").alias("item"))
    if whole:
        near = near.unionByName(_by_grams(windows, known.where(F.col("length").isin(whole)), edits))
    found = near.mapInArrow(_confirm(edits), "doc_id long, text_hash long, item_id long, edits int, start int, end int")
    best = F.min(F.struct("edits", "start", "end")).alias("best")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select("doc_id", "text_hash", "item_id", "best.*")


def clean(docs: DataFrame, items: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """The documents in which no item is found, with all columns."""
    found = staged(matches(docs, items, edits, recall).select("doc_id", "text_hash").distinct(), "leaks")
    # The id tells most rows apart; where it is null or used twice, the text does.
    hit = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    kept = docs.withColumn("__text", F.xxhash64("text")).join(
        hit, (F.col("__text") == F.col("__hash")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_anti")
    return kept.select(*docs.columns)
