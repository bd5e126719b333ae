"""Ranked search over whole texts by the Best Position Algorithm.

One pass counts the items' terms in every document and writes the postings; document frequencies and lengths are
sums over them. The postings are then searched in blocks of documents: a task turns its block into impact lists, one
for each term, in descending order of what the term adds to a document's score. For an item the lists are read side by
side from the top; each document met is looked up in the item's other lists at once, and every position that either
way has shown is marked. Up to a list's best position all its positions are seen, so no unseen document can score more
than the sum of the impacts there. When that sum is strictly below the k-th best score, the block holds nothing more,
not even a tie. A task goes from block to block with the k-th score it has, and the best of all tasks are ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from playtide.llm.common import as_bytes, slices
from playtide.llm.ngram_join import staged

#: Documents, and postings, of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 22
#: Text of the items that are searched in one pass over the documents; more items take more passes.
ITEM_BYTES = 8 << 20
#: Positions read from each list in the first round; each further round reads twice as many as the one before.
FIRST_DEPTH = 8
_SCALE = 1_000_000_000
#: Stands for a null id inside a task: such documents come first among equal scores.
_NO_ID = -(1 << 63)

# Terms are runs of digits, ASCII letters and whatever is beyond ASCII; only A-Z change case.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text in order, with repeats."""
    return text.translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    """A term's weight from the number of documents and of those that hold it."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term: its length, and the vocabulary's terms in it."""
    kind = "doc_id long, n long, terms array<int>, counts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                lengths, ends, terms, counts = [], [0], [], []
                for text in as_bytes(texts):
                    words = terms_of(text)
                    found = Counter(filter(place.__contains__, words))
                    lengths.append(len(words))
                    terms += map(place.__getitem__, found)
                    counts += found.values()
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                rows = pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(texts)), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
                ], ["doc_id", "n", "terms", "counts"])
                at += len(texts)
                yield rows.filter(pc.greater(rows.column("n"), 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


@dataclass(frozen=True)
class Corpus:
    """What the scores need of the whole table."""

    documents: int
    terms: int
    weights: np.ndarray  # of the vocabulary's terms


def corpus(found: DataFrame, size: int) -> Corpus:
    """Counts over all postings; at most one row for each term of the vocabulary comes to the driver."""
    total = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(size, np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[row["term"]] = weight(total["docs"], row["count"])
    return Corpus(total["docs"], total["terms"], weights)


class Block:
    """The impact lists of a block of documents, one after the other, and a way to look a document up in a list."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int):
        self.documents = documents
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        sizes = np.bincount(term) if len(term) else np.zeros(0, np.int64)
        self.ends = np.cumsum(np.r_[0, sizes])
        # The same postings by (term, document), each with its place in the lists.
        keys = term[order].astype(np.int64) * documents + self.doc
        self.by_doc = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_doc]

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms with a list in this block, and where their lists start and end."""
        terms = terms[terms < len(self.ends) - 1]
        start, end = self.ends[terms], self.ends[terms + 1]
        held = end > start
        return terms[held], start[held], end[held]

    def find(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Direct accesses: which of the documents are in which of the lists, and their places there."""
        keys = (terms[:, None] * self.documents + docs[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        return hit // len(docs), hit % len(docs), self.by_doc[at[hit]]


@dataclass
class Best:
    """The k best documents so far, by descending score, then ascending id."""

    k: int
    score: np.ndarray
    doc_id: np.ndarray

    @property
    def least(self) -> int:
        """A score that a document has to reach: the k-th, or 1 while there are fewer."""
        return int(self.score[-1]) if len(self.score) >= self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        good = score >= self.least
        score, doc_id = np.r_[self.score, score[good]], np.r_[self.doc_id, doc_id[good]]
        order = np.lexsort((doc_id, -score))[: self.k]
        self.score, self.doc_id = score[order], doc_id[order]


def search(block: Block, doc_ids: np.ndarray, terms: np.ndarray, best: Best) -> int:
    """Add the block's best documents for one item's terms; returns how many documents were looked up."""
    terms, start, end = block.lists(terms)
    if not len(terms):
        return 0
    size = end - start
    base = np.cumsum(np.r_[0, size])  # the lists' marks, one list after the other
    seen = np.zeros(base[-1], bool)
    met = np.zeros(block.documents, bool)
    reach = np.zeros(len(terms), np.int64)  # seen positions from the top without a gap
    depth, looked_up = 0, 0
    while depth < size.max():
        step = FIRST_DEPTH if not depth else depth
        # Sorted access: the next positions of every list.
        docs = np.concatenate([block.doc[a + depth : min(a + depth + step, b)] for a, b in zip(start.tolist(), end.tolist())])
        depth += step
        docs = np.unique(docs)
        docs = docs[~met[docs]]
        if len(docs):
            met[docs] = True
            looked_up += len(docs)
            of_list, of_doc, place = block.find(terms, docs)
            seen[base[of_list] + place - start[of_list]] = True
            score = np.bincount(of_doc, weights=block.impact[place] >> 32, minlength=len(docs)).astype(np.int64) << 32
            score += np.bincount(of_doc, weights=block.impact[place] & 0xFFFFFFFF, minlength=len(docs)).astype(np.int64)
            best.add(score, doc_ids[docs])
        threshold = 0
        for i in range(len(terms)):
            marks = seen[base[i] + reach[i] : base[i + 1]]
            gap = int(marks.argmin()) if len(marks) else 0
            reach[i] += gap if len(marks) and not marks[gap] else len(marks)
            if reach[i] < size[i]:  # in a list that is seen to its end no document is left
                threshold += int(block.impact[start[i] + reach[i] - 1])
        if threshold < best.least:
            break
    return looked_up


def _search(corpus: Corpus, items: list[tuple], k: int):
    """The k best documents of a task for each item: (item, doc_id, score)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Block]]:
        held, docs, size = [], 0, 0
        for whole in batches:
            for k in range(0, len(whole), 1024):
                batch = whole.slice(k, 1024)
                held.append(batch)
                docs += len(batch)
                size += len(batch.column("terms").flatten())
                if docs >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                    yield block(held)
                    held, docs, size = [], 0, 0
        if held:
            yield block(held)

    def block(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, Block]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        n = rows.column("n").to_pylist()
        m = np.array([10 + 90 * x * corpus.documents // corpus.terms for x in n], np.int64)
        sizes = pc.list_value_length(rows.column("terms")).to_numpy()
        doc = np.repeat(np.arange(len(n)), sizes)
        term = pc.list_flatten(rows.column("terms")).to_numpy()
        count = pc.list_flatten(rows.column("counts")).to_numpy().astype(np.int64)
        impact = corpus.weights[term] * (_SCALE * count // (1000 * count + 8 * m[doc]))
        ids = rows.column("doc_id").fill_null(_NO_ID).to_numpy()
        return ids, Block(doc, term, impact, len(n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k, np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        for ids, lists in blocks(batches):
            for (_, terms), best in zip(items, found, strict=True):
                search(lists, ids, terms, best)
        place = np.repeat(np.arange(len(items)), [len(b.score) for b in found]) if items else np.zeros(0, np.int64)
        ids = np.concatenate([b.doc_id for b in found]) if found else np.zeros(0, np.int64)
        score = np.concatenate([b.score for b in found]) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(ids, mask=ids == _NO_ID), pa.array(score)], ["item", "doc_id", "score"])

    return run


def _item_blocks(items: DataFrame, limit: int) -> list[DataFrame]:
    """The items in parts of about ``limit`` bytes of text, by the hash of the row."""
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-size // limit) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [items.where(part == i) for i in range(parts)]


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents with a score above 0 of each item.

    A null text has no term: such a document is not counted, and such an item finds nothing. Equal scores rank by
    ascending doc_id, null ids first. Each row of documents and of items is one of its own, so rows that repeat an id
    are ranked, or searched, each for itself. Other columns are not read. Empty tables give no row. The
    items go to the tasks in parts of bounded text, one pass over the documents for each part.
    """
    spark = docs.sparkSession
    found = [_top(spark, docs, part, k) for part in _item_blocks(items.select("item_id", "text"), item_bytes)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _top(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    kind = items.schema["item_id"].dataType
    rows = [(r["item_id"], set(terms_of((r["text"] or "").encode()))) for r in items.collect()]
    vocabulary = sorted(set().union(*[t for _, t in rows]))
    place = {t: i for i, t in enumerate(vocabulary)}
    counted = staged(postings(docs, vocabulary), "postings")
    whole = corpus(counted, len(vocabulary))
    searched = [(i, np.array(sorted(map(place.__getitem__, t)), np.int64)) for i, (_, t) in enumerate(rows)]
    best = counted.mapInArrow(_search(whole, searched, k), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # As many rows as the part has items.
    names = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(rows)], f"item int, item_id {kind.simpleString()}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
