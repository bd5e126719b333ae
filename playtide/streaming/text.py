"""Word counts and first-word routing over text lines, batch or stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from playtide.sources.tables import TableStore
from playtide.streaming.fanout import start_query

# First words that have a table of their own.
ROUTES = {"ONE": "table_one", "TWO": "table_two"}
OTHER_ROUTE = "table_other"


def words(lines: DataFrame, delimiter: str = " ") -> DataFrame:
    """One row per word of each line; two delimiters in a row hold an empty word."""
    return lines.select(F.explode(F.split("value", re.escape(delimiter))).alias("word"))


def word_count(lines: DataFrame, delimiter: str = " ") -> DataFrame:
    return words(lines, delimiter).groupBy("word").count()


def first_word_routes(lines: DataFrame) -> DataFrame:
    """The table each line goes to by its first word, and the rest of the line (null if none)."""
    parts = F.split("value", " ", 2)
    first = F.get(parts, F.lit(0))
    route = F.lit(OTHER_ROUTE)
    for word, table in ROUTES.items():
        route = F.when(first == word, table).otherwise(route)
    return lines.select(route.alias("route"), F.get(parts, F.lit(1)).alias("payload"))


def start_word_count(
    lines: DataFrame,
    store: TableStore,
    table: str,
    checkpoint: str,
    delimiter: str = " ",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Running count of each word; every batch replaces the table with all counts so far."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.replace(batch, table)

    return start_query(word_count(lines, delimiter), "complete", write, checkpoint, trigger)


def start_console_word_count(lines: DataFrame, checkpoint: str, delimiter: str = " ") -> StreamingQuery:
    """Running count of each word, printed after every batch."""
    writer = word_count(lines, delimiter).writeStream.outputMode("complete").format("console")
    return writer.option("checkpointLocation", checkpoint).start()


def start_routes(
    lines: DataFrame, store: TableStore, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write each line to the table its first word names."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for table in (*ROUTES.values(), OTHER_ROUTE):
                rows = batch.where(F.col("route") == table).select("payload")
                store.write_batch(rows, table, batch_id)
        finally:
            batch.unpersist()

    return start_query(first_word_routes(lines), "append", write, checkpoint, trigger)
