"""What each filter of a chain removes, for every order in which the filters could be applied.

A document's outcome under any order depends only on the set of filters it fails, a mask of bits. So the documents are
counted once by part and mask, and the orders are enumerated over the masks instead of the documents: a recursive
query extends each prefix of filters by a letter that it lacks, joined with every mask cell, and carries the bits that
were applied before. Each level holds the rows of that step; joined with the counted cells they give its metrics.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from playtide.llm.common import as_bytes, slices
from playtide.llm.ngram_join import staged
from playtide.operators.skew import split_hot_join

FILTERS = "ABCDE"
#: Limits of the filters: least words; least different words and most capitals, both in hundredths.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))


def measured(text: Column) -> Column:
    """``mask`` of the filters A to D that a text fails, and a ``digest`` of the text; a null is empty."""

    @F.arrow_udf("struct<mask: int, digest: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            masks, digests = [], []
            for piece in slices(texts):
                sizes = pc.fill_null(pc.utf8_length(piece), 0).to_pylist()
                for raw, size in zip(as_bytes(piece), sizes, strict=True):
                    words = raw.split()  # bytes part at the six ASCII white space characters only
                    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
                    masks.append(
                        (len(words) < LEAST_WORDS)
                        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
                        | (100 * capitals > MOST_CAPITALS * size) << 2
                        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)
                    digests.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.StructArray.from_arrays([pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["mask", "digest"])

    return run(text)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the set of filters they fail, with filter E as bit 16.

    Rows that agree in id, part and text are counted first. What repeats is settled by digest, with minima that combine
    on the map side, so a text or an id of a third of all rows reaches its reducer as few rows.
    """
    checked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), measured(F.col("text")).alias("m"))
    rows = checked.groupBy("doc_id", "part", F.col("m.mask").alias("mask"), F.col("m.digest").alias("digest")).agg(F.count("*").alias("n"))
    rows = staged(rows, "checked")  # the join looks for large keys first
    # A document is good, or toxic, if any of its labels says so.
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    labelled = split_hot_join(rows, known, ["doc_id"], "left")
    keys = ["digest", "mask", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # Of each text and kind of row: its rows, its least id, and how many rows have that id (null ids are no smaller id).
    by_id = labelled.groupBy(*keys, "doc_id").agg(F.sum("n").alias("n"))
    kinds = by_id.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    # The least id of a text among its kinds, of which there are as many as parts and labels.
    each = kinds.withColumn("first", F.min("least").over(Window.partitionBy("digest", "mask")))
    firsts = F.col("n_null") + F.coalesce(F.when(F.col("least") == F.col("first"), F.col("n_least")), F.lit(0))
    halves = F.array(F.struct(F.col("mask"), firsts.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - firsts).alias("n")))
    split = each.select("part", "good", "toxic", F.explode(halves).alias("h")).select("part", "good", "toxic", "h.*").where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))


def steps(spark: SparkSession) -> DataFrame:
    """(prefix, step, bit, mask, applied) of each prefix of an order and each mask cell: 325 prefixes, 32 cells.

    ``bit`` is the filter of the step and ``applied`` the bits of the filters before it.
    """
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(FILTERS))
    return spark.sql(f"""
        WITH RECURSIVE letters(letter, bit) AS (VALUES {letters}),
        grid(mask) AS (SELECT CAST(id AS INT) FROM range({1 << len(FILTERS)})),
        prefixes(prefix, step, bit, applied, mask) AS (
          SELECT CAST(letter AS STRING), 1, bit, 0, mask FROM letters CROSS JOIN grid
          UNION ALL
          SELECT p.prefix || l.letter, p.step + 1, l.bit, p.applied | p.bit, p.mask
          FROM prefixes p JOIN letters l ON ((p.applied | p.bit) & l.bit) = 0
          WHERE p.step < {len(FILTERS)}
        )
        SELECT * FROM prefixes
    """)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with counts of that step.

    ``part`` is the language, empty for a null. A null text is empty, and equal to an empty one; a row without id has
    no smaller id before it nor comes before any. Rows that repeat are documents of their own. Several labels of one
    id count as one; labels without a document, and other columns, play no part. No documents give no row.
    """
    counted, all_steps = cells(docs, labels), steps(docs.sparkSession)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("applied")) != 0
    total = lambda value, when: F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0))
    # The steps are 10,400 rows whatever the tables hold.
    by_prefix = counted.join(F.broadcast(all_steps), "mask").groupBy("part", "prefix", "step", "bit").agg(
        total("docs", ~gone & ~fails).alias("kept"),
        total("docs", ~gone & fails).alias("removed"),
        total("docs", gone & fails).alias("redundant"),
        total("docs", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", ~gone & fails).alias("good_lost"),
        total("toxic", ~gone & fails).alias("toxic_lost"))
    # An order's step is that of its prefix; 600 rows.
    orders = all_steps.where((F.col("step") == len(FILTERS)) & (F.col("mask") == 0)).select(F.col("prefix").alias("filter_order"))
    places = orders.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    places = places.withColumn("prefix", F.expr("left(filter_order, step)"))
    rows = by_prefix.join(F.broadcast(places), ["prefix", "step"])
    shares = rows.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    out = rows.join(shares, ["part", "bit"])
    metrics = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.select("part", "filter_order", F.col("step").cast("int").alias("step"), *(F.col(c).cast("long").alias(c) for c in metrics))
