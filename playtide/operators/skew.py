"""Joins that hold when one key has a third of all rows.

A side is broadcast only after its size was measured. Otherwise the rows of each key are counted, and every key with
more rows than a task should get is spread over several. Spark's own skew join does that only where both inputs come
straight from a shuffle; next to an aggregated or distinct input it leaves a large partition whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from playtide.session import work_dir

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
#: Rows of one key that a task of a join should get; a key with more is hot.
ROWS_PER_TASK = 1 << 20
#: Hot keys at most: the limit of rows is raised on inputs so large that there could be more, so their table, of two
#: numbers a key, stays within 16 MB and is broadcast.
MOST_HOT = 1 << 20
#: Tasks that null keys, which match nothing, are spread over at least.
NULL_TASKS = 32

_HASH, _SALT, _TASKS = "__key_hash", "__salt", "__tasks"


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows of a frame take, from one aggregation over it."""
    fixed, variable = 0, []
    for field in df.schema.fields:
        fixed += 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)))
    width = reduce(lambda a, b: a + b, variable, F.lit(fixed)).cast("bigint")
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit_bytes


def _key_hash(keys: list[str]) -> Column:
    # As text, so that an int and a bigint key of equal value hash alike.
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _blank(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


@dataclass(frozen=True)
class Hot:
    """The keys with more rows than a task should get: a stored table of key hash and tasks, None where there is none."""

    table: DataFrame | None = None
    null_tasks: int = NULL_TASKS

    def with_tasks(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """The rows with the number of tasks that their key goes to; 1 for keys that are not hot."""
        if self.table is None:
            return df.withColumn(_TASKS, F.lit(1))
        known = df.withColumn(_HASH, _key_hash(keys)).join(F.broadcast(self.table), _HASH, "left")
        return known.withColumn(_TASKS, F.coalesce(_TASKS, F.lit(1))).drop(_HASH)


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> Hot:
    """The keys that hold more than ``rows_per_task`` rows of a frame, from a count of all its keys.

    The count combines on the map side, so a key of any share is counted from few rows.
    """
    counts = df.select(F.when(~_blank(keys), _key_hash(keys)).alias(_HASH)).groupBy(_HASH).agg(F.count("*").alias("n"))
    return _hot(counts, rows_per_task)


def hot_counted(counts: DataFrame, keys: list[str], n: str, rows_per_task: int = ROWS_PER_TASK) -> Hot:
    """The same from a frame that has the rows of each key in a column ``n`` already, such as the aggregate to join with."""
    hashed = F.when(~_blank(keys), _key_hash(keys)).alias(_HASH)
    return _hot(counts.select(hashed, F.col(n).cast("bigint").alias("n")), rows_per_task)


def _hot(counts: DataFrame, rows_per_task: float) -> Hot:
    seen = Observation()
    large = counts.observe(seen, F.sum("n").alias("rows")).where((F.col("n") > rows_per_task) | F.col(_HASH).isNull())
    path = work_dir(counts.sparkSession, "hot-keys")
    large.write.parquet(path)
    limit = max(rows_per_task, (seen.get["rows"] or 0) / MOST_HOT)
    stored = counts.sparkSession.read.parquet(path)
    hot = stored.where(F.col(_HASH).isNotNull() & (F.col("n") > limit))
    found = stored.agg(
        F.count_if(F.col(_HASH).isNotNull() & (F.col("n") > limit)).alias("hot"),
        F.coalesce(F.sum(F.when(F.col(_HASH).isNull(), F.col("n"))), F.lit(0)).alias("blank"),
    ).first()
    # Several keys of one hash share their tasks.
    tasks = hot.groupBy(_HASH).agg(F.ceil(F.sum("n") / F.lit(limit)).cast("int").alias(_TASKS))
    return Hot(tasks if found["hot"] else None, max(NULL_TASKS, -(-found["blank"] // max(1, int(limit)))))


def _salted(df: DataFrame, keys: list[str], hot: Hot) -> DataFrame:
    """Rows of hot keys, and of null keys, get one of their key's salts.

    The salt comes from the row and its input partition: a task that runs again gives the same
    salts, and equal copies of a row in different partitions still spread.
    """
    tasks = F.when(_blank(keys), hot.null_tasks).otherwise(F.col(_TASKS))
    salt = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), tasks).cast("int")
    return hot.with_tasks(df, keys).withColumn(_SALT, salt).drop(_TASKS)


def _copied(df: DataFrame, keys: list[str], hot: Hot) -> DataFrame:
    """Rows of hot keys once per salt, all others with salt 0."""
    if hot.table is None:
        return df.withColumn(_SALT, F.lit(0))
    salts = F.explode(F.sequence(F.lit(0), F.col(_TASKS) - 1))
    return hot.with_tasks(df, keys).withColumn(_SALT, salts).drop(_TASKS)


def split_hot_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, rows_per_task: int = ROWS_PER_TASK, hot: Hot | None = None
) -> DataFrame:
    """Equi-join on same-named keys whose hot left keys are spread over several partitions.

    For ``inner``, ``left`` and ``left_semi``: each left row meets all right rows of its key
    exactly once, because the right rows of hot keys are present under every salt. The left side is read once more
    for its counts unless ``hot`` gives them. A stream cannot be counted ahead, so only its null keys are spread.
    """
    for key in keys:
        kinds = left.schema[key].dataType, right.schema[key].dataType
        if kinds[0] != kinds[1] and not all(isinstance(k, T.IntegralType) for k in kinds):
            raise TypeError(f"join key {key} has types {kinds[0]} and {kinds[1]}")
    if hot is None:
        hot = Hot() if left.isStreaming else hot_keys(left, keys, rows_per_task)
    right = right.na.drop(subset=keys)  # null keys match nothing
    if how in ("inner", "left_semi"):
        left = left.na.drop(subset=keys)
        if hot.table is None:
            return left.join(right, keys, how)
    return _salted(left, keys, hot).join(_copied(right, keys, hot), [*keys, _SALT], how).drop(_SALT)


def semi_join(
    df: DataFrame, keys_of: DataFrame, key: str, limit_bytes: int = BROADCAST_LIMIT_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_of``.

    The different keys are broadcast when their measured size is within the limit, and ``df`` is then read once and
    not shuffled; beyond it both sides stay distributed and hot keys are split.
    """
    wanted = keys_of.select(key).where(F.col(key).isNotNull()).distinct()
    if fits_broadcast(wanted, limit_bytes):
        return df.join(F.broadcast(wanted), key, "left_semi").select(*df.columns)
    return split_hot_join(df, wanted, [key], "left_semi", rows_per_task).select(*df.columns)
