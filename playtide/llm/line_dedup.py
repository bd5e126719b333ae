"""Removal of repeated text: lines, and the sentences inside them, by their digests.

A unit is a whole line, or a sentence or what is left of its line, or a run of such sentences. Its words are lower-cased
and joined by one blank; digests of these are grouped over all documents, the earliest unit stays, and the others are
listed with their offsets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from playtide.llm.common import as_strings, slices
from playtide.llm.ngram_join import staged
from playtide.operators.skew import hot_counted, split_hot_join

#: Units of fewer words or characters (after normalising) are never removed: they recur by chance.
LEAST_WORDS, LEAST_CHARS = 6, 40

#: A line end or a full stop, question or exclamation mark before white space ends a unit.
UNIT = r"[^.!?\n]+(?:[.!?]+[^.!?\x20\x09-\x0D][^.!?\n]*)*[.!?]*"
_UNIT = regex.compile(UNIT)
_SPACE = " \t\n\v\f\r"
_CUT = regex.compile(r"[.!?][\x20\x09-\x0D]")


def _unit(raw: str, least_words: int, least_chars: int) -> bytes | None:
    """The digest of a unit without white space around it, or None if it is too short to go."""
    if len(raw) < least_chars:
        return None
    whole = raw.encode()
    words = whole.split()  # bytes part at ASCII white space only
    if len(words) < least_words:
        return None
    normal = b" ".join(words).lower()  # and have ASCII cases only
    if len(raw) - len(whole) + len(normal) < least_chars:
        return None
    return hashlib.blake2b(normal, digest_size=16).digest()


def units(text: str, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the sentences that may be removed, in code points, without white space around them."""
    out = []
    for m in _UNIT.finditer(text):
        raw = m[0].strip(_SPACE)
        if digest := _unit(raw, least_words, least_chars):
            start = m.start() + m[0].index(raw)
            out.append((start, start + len(raw), digest))
    return out


def line_units(text: str, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS) -> list[tuple[int, int, bytes, int]]:
    """(start, end, digest, start of its line) of the lines that may be removed, each before those of its sentences.

    The floor holds for the line as a whole, however short its sentences are. A line of one sentence is one unit.
    Sentences are cut with a blank before the line, so that they do not depend on white space around it.
    """
    out, at = [], 0
    for line in text.split("\n"):
        raw = line.strip(_SPACE)
        if digest := _unit(raw, least_words, least_chars):
            begin = at + line.index(raw)
            out.append((begin, begin + len(raw), digest, begin))
            parts = units(f" {raw}", least_words, least_chars) if _CUT.search(raw) else []
            out += [(begin + s - 1, begin + e - 1, d, begin) for s, e, d in parts if e - s < len(raw)]
        at += len(line) + 1
    return out


def run_units(text: str, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the shortest runs of consecutive sentences that meet the floor together.

    Runs are taken from each sentence on and up to each sentence, so whatever two texts share in whole sentences that
    meet the floor together is covered by runs of it, to the last sentence. Line ends end sentences, but not runs.
    """
    sentences, at = [], 0
    for line in text.split("\n"):
        if raw := line.strip(_SPACE):
            begin = at + line.index(raw) - 1
            for m in _UNIT.finditer(f" {raw}"):
                body = m[0].strip(_SPACE)
                if words := body.encode().split():
                    start = begin + m.start() + m[0].index(body)
                    normal = b" ".join(words).lower()
                    sentences.append((start, start + len(body), len(words), len(normal.decode()) + 1, normal))
        at += len(line) + 1
    n_words = list(accumulate((s[2] for s in sentences), initial=0))
    n_chars = list(accumulate((s[3] for s in sentences), initial=0))  # with a blank behind each

    def enough(i: int, j: int) -> bool:
        return n_words[j] - n_words[i] >= least_words and n_chars[j] - n_chars[i] - 1 >= least_chars

    spans, i, j = set(), 0, 0
    for first in range(len(sentences)):
        while j < len(sentences) and not enough(first, j):
            j += 1
        if enough(first, j):
            spans.add((first, j))
    for last in range(1, len(sentences) + 1):
        while enough(i + 1, last):
            i += 1
        if enough(i, last):
            spans.add((i, last))
    return [(sentences[a][0], sentences[b - 1][1], hashlib.blake2b(b" ".join(s[4] for s in sentences[a:b]), digest_size=16).digest())
            for a, b in sorted(spans)]


def _units(least_words: int, least_chars: int, lines: bool, runs: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()), ("end", pa.int32()),
                        ("line", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text")):
                if runs:
                    found = [[(*u, None) for u in run_units(t, least_words, least_chars)] for t in as_strings(texts)]
                elif lines:
                    found = [line_units(t, least_words, least_chars) for t in as_strings(texts)]
                else:
                    found = [[(*u, None) for u in units(t, least_words, least_chars)] for t in as_strings(texts)]
                take = pa.array(np.repeat(np.arange(at, at + len(texts)), [len(f) for f in found]))
                at += len(texts)
                flat = [u for f in found for u in f]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(take), batch.column("text_hash").take(take),
                    pa.array([u[2] for u in flat], pa.binary()), pa.array([u[0] for u in flat], pa.int32()),
                    pa.array([u[1] for u in flat], pa.int32()), pa.array([u[3] for u in flat], pa.int32())], schema=schema)

    return run


def repeated(docs: DataFrame, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS, lines: bool = True, runs: bool = False) -> DataFrame:
    """(doc_id, text_hash, start, end, kept_doc_id, kept_start) of each unit to remove.

    Documents rank by doc_id, nulls last, then by the hash of their text; units rank by document and then by offset,
    and the first of each group stays. Null and blank texts have no units. Rows that are equal as a whole have equal
    units at equal offsets: they count as one document. Other columns are not read. A unit that a third of all
    documents share comes to the grouping once from each task; how often it occurs is counted there, and the join
    spreads one with more places than a task should get over several tasks.

    ``lines``: whole lines go too, and a line that goes is listed once for all of its sentences, which stand in its
    kept copy; without it only sentences go.

    ``runs``: in place of lines, runs of consecutive sentences go that meet the floor together, however short each is.
    They may overlap; ``passages`` joins them. The first place of each sentence stays.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    found = staged(rows.mapInArrow(
        _units(least_words, least_chars, lines, runs), "doc_id long, text_hash long, digest binary, start int, end int, line int"), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "text_hash", "start")
    first = found.groupBy("digest").agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count("*").alias("places"))
    first = staged(first.where("first <> last").select("digest", "first", "places"), "repeated-units")
    hot = hot_counted(first, ["digest"], "places")
    removed = split_hot_join(found, first, ["digest"], "inner", hot=hot).where(rank != F.col("first")).select(
        "doc_id", "text_hash", "line", "start", "end", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.start").alias("kept_start"))
    return _outermost(removed) if lines and not runs else removed.drop("line")


def _outermost(removed: DataFrame) -> DataFrame:
    """Without the sentences of lines that go whole: a line's units that begin with it, the longest first."""
    span = F.struct("start", "end", "kept_doc_id", "kept_start")
    longest = F.max(F.when(F.col("start") == F.col("line"), F.col("end"))).alias("longest")
    grouped = removed.groupBy("doc_id", "text_hash", "line").agg(longest, F.collect_set(span).alias("spans"))
    # A first sentence reaches over no other, so only a whole line leaves any out.
    outer = F.filter("spans", lambda s: (s["end"] == F.col("longest")) & (s["start"] == F.col("line")) | (s["start"] >= F.coalesce("longest", "line")))
    return grouped.select("doc_id", "text_hash", F.explode(outer).alias("s")).select("doc_id", "text_hash", "s.*")


def passages(removed: DataFrame) -> DataFrame:
    """Removed units that overlap as one, with the first of the documents that keep a part of it."""
    text = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    before = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = removed.withColumn("fresh", F.when(F.col("start") <= before, 0).otherwise(1))
    first = F.min(F.struct(F.col("kept_doc_id").isNull().alias("blank"), "kept_doc_id", "kept_start"))
    return fresh.withColumn("passage", F.sum("fresh").over(text)).groupBy("doc_id", "text_hash", "passage").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), first.alias("first"),
    ).select("doc_id", "text_hash", "start", "end", "first.kept_doc_id", "first.kept_start")


def by_document(removed: DataFrame) -> DataFrame:
    """One row for each document that loses text: its removed units in order."""
    spans = F.array_sort(F.collect_set(F.struct("start", "end", "kept_doc_id", "kept_start")))
    return removed.groupBy("doc_id", "text_hash").agg(spans.alias("removed"))


def without(text: Column, removed: Column) -> Column:
    """The text with the removed units cut out; what stays is not touched. Null spans cut nothing."""

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, cuts in batches:
            out = []
            for whole, spans in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
                at, parts = 0, []
                for span in spans or []:
                    parts.append(whole[at : span["start"]])
                    at = max(at, span["end"])
                out.append(whole if whole is None or not parts else "".join([*parts, whole[at:]]))
            yield pa.array(out, pa.string())

    return run(text, removed)


def deduplicated(docs: DataFrame, **limits) -> DataFrame:
    """All rows and columns of ``docs`` with repeated units cut out of their texts."""
    removed = by_document(repeated(docs, **limits)).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__removed"))
    joined = docs.withColumn("__text", F.xxhash64("text")).join(
        removed, (F.col("__text") == F.col("__hash")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left")
    return joined.withColumn("text", without(F.col("text"), F.col("__removed"))).select(*docs.columns)
