"""One message stream into five tables, with cumulative watch time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from playtide.operators.plays import add_durations, merge_watch_time
from playtide.operators.skew import fits_broadcast
from playtide.session import work_scope
from playtide.sources.tables import FolderStore, TableStore, staged
from playtide.streaming.messages import (
    BRANCHES, VIEWING_KEYS, WATCH_KEYS, decode_heartbeats, decode_messages, with_experiment,
)

EVERY_TWO_SECONDS = {"processingTime": "2 seconds"}
DEAD_LETTERS = "dead_letters"
Decoder = Callable[[DataFrame], DataFrame]


def write_branches(
    messages: DataFrame, tables: Iterable[str], store: TableStore, batch_id: int, arrival: Column
) -> None:
    """Write one micro-batch to its tables, and records that cannot be read to the dead letters."""
    messages.persist()
    try:
        rejected = [messages.where(~F.col("readable")).select(F.lit(None).cast("string").alias("branch"), "record")]
        for name in tables:
            branch = BRANCHES[name]
            rows = branch.apply(messages, arrival)
            if name != "video_play":  # its totals are a query of their own
                store.write_batch(rows.where(branch.usable()).drop("record"), name, batch_id)
            bad = rows.where(~branch.usable())
            rejected.append(bad.select(F.lit(name).alias("branch"), "record"))
        dead = reduce(DataFrame.unionByName, rejected)
        if not dead.isEmpty():
            store.write_batch(dead, DEAD_LETTERS, batch_id)
    finally:
        messages.unpersist()


def watch_totals(messages: DataFrame, arrival: Column) -> DataFrame:
    """Cumulative watch time per key; on a stream the totals are kept as state."""
    branch = BRANCHES["video_play"]
    rows = branch.apply(messages, arrival).where(branch.usable())
    return rows.groupBy(*WATCH_KEYS).agg(
        F.sum("duration").alias("duration"), F.max("event_datetime").alias("event_datetime")
    )


def latest_totals(log: DataFrame, keys: tuple[str, ...] = WATCH_KEYS, *more: str) -> DataFrame:
    """The current total of each key, from a log to which every batch appended its new totals: that of the last batch.

    ``more`` names columns whose largest value is kept as well.
    """
    return log.groupBy(*keys).agg(
        F.max_by("duration", "batch_id").alias("duration"), F.max("event_datetime").alias("event_datetime"),
        *(F.max(c).alias(c) for c in more),
    )


def start_fan_out(
    stream: DataFrame,
    names: DataFrame,
    store: TableStore,
    checkpoint: str,
    tables: Iterable[str] = tuple(BRANCHES),
    trigger: dict | None = None,
    arrival: Column | None = None,
    decode: Decoder = decode_messages,
    decode_beats: Decoder | None = None,
) -> list[StreamingQuery]:
    """Start the stream jobs and return their queries.

    The append-only tables and the dead letters share one query that decodes each micro-batch once.
    Watch time is a second query with the totals as state: it emits the new totals of the keys in the
    batch and never reads its table back. It parses heartbeats only (``decode_beats``; with a decoder of the caller's own
    that one, unless both are given). Each batch writes under its own id, so a batch that is run again replaces its rows.
    """
    beats = decode_beats or (decode_heartbeats if decode is decode_messages else decode)
    tables = list(tables)
    small = fits_broadcast(names)
    now = F.current_timestamp() if arrival is None else arrival
    messages = with_experiment(decode(stream), names, small=small)
    queries = []

    def route(batch: DataFrame, batch_id: int) -> None:
        write_branches(batch, tables, store, batch_id, now)

    queries.append(start_query(messages, "append", route, f"{checkpoint}/branches", trigger))
    if "video_play" in tables:
        def totals(batch: DataFrame, batch_id: int) -> None:
            store.write_batch(batch, "video_play", batch_id)

        watched = watch_totals(with_experiment(beats(stream), names, small=small), now)
        queries.append(start_query(watched, "update", totals, f"{checkpoint}/video_play", trigger))
    return queries


def start_query(
    df: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or EVERY_TWO_SECONDS)).start()


def run_to_end(queries: list[StreamingQuery]) -> None:
    """Wait for queries started with ``{"availableNow": True}``; a failed one raises here."""
    for query in queries:
        query.awaitTermination()


#: Batches after which the totals of a log are folded into a snapshot.
FOLD_EVERY = 16


def append_totals(
    rows: DataFrame, store: FolderStore, table: str, batch_id: int, keys: tuple[str, ...] = WATCH_KEYS,
    fold_every: int = FOLD_EVERY,
) -> None:
    """Add a micro-batch's watch rows to the totals in a table, for stores that hold earlier totals.

    Only totals of earlier batches count, so running a batch again gives the same rows. They come from a snapshot with
    the latest total of each key and from the batches after it, at most ``fold_every`` and a few, however long the log is.
    """
    earlier = _totals_before(store, table, batch_id, keys, fold_every)
    if earlier is not None:
        totals = merge_watch_time(rows, earlier, keys)
    else:
        totals = rows.groupBy(*keys).agg(
            F.sum("duration").alias("duration"), F.max("event_datetime").alias("event_datetime")
        )
    store.write_batch(totals, table, batch_id)


def _totals_before(
    store: FolderStore, table: str, batch_id: int, keys: tuple[str, ...], fold_every: int
) -> DataFrame | None:
    """Totals of the batches before this one; folds them first when the snapshot is ``fold_every`` batches old.

    The snapshot's version is the number of batches it covers, so a fold that failed is found undone, and a batch
    that comes again after its own fold reads the log instead.
    """
    snapshot = f"{table}__snapshot"
    covered = store.version(snapshot) or 0
    if covered > batch_id:
        return store.batches(table, -1, batch_id)
    columns = [*keys, "duration", "event_datetime", "batch_id"]
    parts = [store.buckets(snapshot), store.batches(table, covered - 1, batch_id)]
    found = [p.select(*columns) for p in parts if p is not None]
    if not found:
        return None
    earlier = reduce(DataFrame.unionByName, found)
    if batch_id - covered < fold_every:
        return earlier
    folded = latest_totals(earlier, keys, "batch_id").withColumn("bucket", F.lit(0))
    store.replace_buckets(folded, snapshot, batch_id)
    return store.buckets(snapshot).select(*columns)


#: Parts of a table of sums; a batch rewrites those that its keys fall into. Fixed for the life of a table.
BUCKETS = 64


def rewrite_totals(
    rows: DataFrame, store: TableStore, table: str, batch_id: int, keys: tuple[str, ...] = VIEWING_KEYS,
    buckets: int = BUCKETS,
) -> bool:
    """Rewrite a table of summed durations with a micro-batch added; says whether it did.

    In a folder store only the buckets of the batch's keys are read and written. The table's version is the last batch
    that was added, so a batch that comes again is left out. Other stores rewrite the table as a whole, and
    every row carries the last batch.
    """
    if isinstance(store, FolderStore):
        with work_scope(store.spark):
            return _rewrite_buckets(rows, store, table, batch_id, keys, buckets)
    held = store.find(table)
    total = rows.groupBy(*keys).agg(F.sum("duration").alias("duration"))
    if held is not None:
        last = held.agg(F.max("last_batch")).first()[0]
        if last is not None and last >= batch_id:
            return False
        total = add_durations(rows, held, keys)
    store.replace(total.withColumn("last_batch", F.lit(batch_id).cast("bigint")), table)
    return True


def _rewrite_buckets(
    rows: DataFrame, store: FolderStore, table: str, batch_id: int, keys: tuple[str, ...], buckets: int
) -> bool:
    last = store.version(table)
    if last is not None and last >= batch_id:
        return False
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    sums = rows.groupBy(*keys).agg(F.sum("duration").alias("duration"))
    sums = staged(sums.withColumn("bucket", bucket), "batch-sums")
    touched = [r["bucket"] for r in sums.select("bucket").distinct().collect()]  # at most as many as buckets
    if not touched:
        return True
    held = store.buckets(table, touched)
    total = sums.drop("bucket") if held is None else add_durations(sums, held, keys)
    store.replace_buckets(total.withColumn("bucket", bucket), table, batch_id)
    return True


def start_rewrite(
    stream: DataFrame,
    names: DataFrame,
    store: TableStore,
    table: str,
    checkpoint: str,
    trigger: dict | None = None,
    arrival: Column | None = None,
    decode: Decoder = decode_messages,
) -> StreamingQuery:
    """Keep a table of total watch time per user, content and experiment by rewriting it per batch."""
    now = F.current_timestamp() if arrival is None else arrival
    branch = BRANCHES["video_play"]
    rows = branch.apply(with_experiment(decode(stream), names, small=fits_broadcast(names)), now)

    def write(batch: DataFrame, batch_id: int) -> None:
        rewrite_totals(batch.where(branch.usable()), store, table, batch_id)

    return start_query(rows, "append", write, checkpoint, trigger)


def start_batch_counts(
    stream: DataFrame, store: TableStore, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Number of rows of each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch.agg(F.count("*").alias("n")), table, batch_id)

    return start_query(stream, "append", write, checkpoint, trigger)
