"""Where the pipelines' tables live: a folder, the session's catalog, or a JDBC database."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from playtide.schemas import FACT_TIMES
from playtide.session import remove_folders, work_dir, work_scope

_BATCH, _RUN, _DATE, _BUCKET, _VERSION = "batch_id", "run_id", "date", "bucket", "version"
#: Before a run id in a folder's name, so that no id is read as a number or a date.
_RUN_NAME = "run-"
#: Rows without a time are kept under this date, so that every row has one to be found by.
NO_DATE = "1970-01-01"


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first rows, for a run that should not write."""
    return df.limit(n)


def staged(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """The frame's rows, written once to the shared work folder and read back as Parquet.

    For rows that are costly to compute and used by more than one branch: the branches read just
    their columns, and a lost executor costs no more than its tasks. A branch that filters by a column of
    ``partition_by`` reads just its rows, too.
    """
    path = work_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(_ends_with(df, partition_by)).parquet(path)


def _ends_with(df: DataFrame, columns: tuple[str, ...]) -> T.StructType:
    """The schema as it is read back: partition columns come last, and keep their type also where there is no row."""
    order = [c for c in df.columns if c not in columns] + list(columns)
    return df.select(*order).schema


def dated(df: DataFrame, table: str) -> DataFrame:
    """The rows of a fact table with the date they are stored by; other tables as they are."""
    time = FACT_TIMES.get(table)
    if time is None or _DATE in df.columns:
        return df
    return df.withColumn(_DATE, date_of(F.col(time)))


def date_of(time: Column) -> Column:
    """The date a fact row is stored by."""
    return F.coalesce(time.cast("date"), F.lit(NO_DATE).cast("date"))


def in_dates(df: DataFrame, start=None, end=None) -> DataFrame:
    """The rows whose stored date lies in the days from ``start`` to ``end``: whole folders are left out.

    A frame without stored dates stays as it is. Rows at the edge days stay, for a filter by time to decide.
    """
    if _DATE not in df.columns:
        return df
    day = F.col(_DATE)
    if start is not None:
        df = df.where(day >= F.lit(start).cast("timestamp").cast("date"))
    if end is not None:
        df = df.where(day <= F.lit(end).cast("timestamp").cast("date"))
    return df


class FolderStore:
    """One folder of Parquet (or another file format) per table.

    ``append`` adds files. With a run id, or by ``write_batch`` for a micro-batch, rows go to a folder of their own
    that the same run or batch replaces when it comes again. ``replace`` writes a new version beside the old one
    and then names it in a small list of versions, so a table can be rewritten from its own rows and a
    reader sees either all of the old rows or all of the new. The version before the old one makes room for the new one.
    Whatever is written after a ``replace`` goes to the latest version, and a read gives all kinds of rows together.

    Fact tables (``schemas.FACT_TIMES``) are stored by date, in a column ``date``.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _slot(self, table: str, version: int) -> str:
        return f"{self.path(table)}__v{version % 2}"

    def _load(self, *paths: str, base: str | None = None) -> DataFrame | None:
        if not any(self._names(path) for path in paths):
            return None
        reader = self.spark.read.format(self.fmt)
        try:
            return (reader.option("basePath", base) if base else reader).load(list(paths))
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without rows
                return None
            raise

    def _names(self, pattern: str) -> list[str]:
        """The paths of files and folders that match a pattern, from one listing and without opening any."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [entry.getPath().toString() for entry in store.globStatus(path) or []]

    def version(self, table: str) -> int | None:
        """The latest version that was named, None for a table that was never rewritten."""
        named = [int(n.rsplit("=", 1)[1]) for n in self._names(f"{self.path(table)}__versions/{_VERSION}=*")]
        return max(named, default=None)

    def _name_version(self, table: str, version: int) -> None:
        """From here on readers see this version. Names of versions long past are removed."""
        marker = f"{self.path(table)}__versions/{_VERSION}="
        self.spark.range(1).write.format(self.fmt).mode("overwrite").save(f"{marker}{version}")
        remove_folders(self.spark, [n for n in self._names(f"{marker}*") if int(n.rsplit("=", 1)[1]) < version - 1])

    def home(self, table: str) -> str:
        """The folder that holds the table's rows now."""
        version = self.version(table)
        rewritten = version is not None and not self._names(f"{self.path(table)}/{_BUCKET}=*")
        return self._slot(table, version) if rewritten else self.path(table)

    def _kinds(self, home: str) -> set[str]:
        """Which kinds of entries a folder has: plain files, or the partition column of its folders."""
        names = [path.rsplit("/", 1)[1] for path in self._names(f"{home}/*")]
        return {n.split("=")[0] if "=" in n else "" for n in names if not n.startswith(("_", "."))}

    def find(self, table: str) -> DataFrame | None:
        """The table's rows, or None when nothing was written yet."""
        home = self.home(table)
        if self._names(f"{home}/{_BUCKET}=*"):
            return self.buckets(table)
        # Spark's discovery of partitions takes folders of one kind, and no files beside them.
        parts = [self._part(home, kind) for kind in sorted(self._kinds(home))]
        parts = [p for p in parts if p is not None]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _part(self, home: str, kind: str) -> DataFrame | None:
        rows = self._load(f"{home}/{kind}=*", base=home) if kind else self._load(f"{home}/part-*")
        if rows is None or kind != _RUN:
            return rows
        return rows.withColumn(_RUN, F.substr(_RUN, F.lit(len(_RUN_NAME) + 1)))

    def scan(self, table: str) -> DataFrame:
        found = self.find(table)
        if found is None:
            raise LookupError(f"no table {table} under {self.root}")
        return found

    def _writer(self, df: DataFrame, table: str, mode: str) -> DataFrameWriter:
        rows = dated(df, table)
        if rows is df:
            return df.write.format(self.fmt).mode(mode)
        # Few files for each date, and a date too large for one task is split.
        return rows.hint("rebalance", _DATE).write.format(self.fmt).mode(mode).partitionBy(_DATE)

    def append(self, df: DataFrame, table: str, run_id: str | None = None) -> None:
        """Add rows. The rows that an earlier run of the same id added are replaced."""
        home = self.home(table)
        if run_id is None:
            self._writer(df, table, "append").save(home)
        elif not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"a run id names a folder: letters, digits, '_', '.' and '-' only, not {run_id!r}")
        else:
            self._writer(df, table, "overwrite").save(f"{home}/{_RUN}={_RUN_NAME}{run_id}")
        self._keep_schema(df, table, home)

    def _keep_schema(self, df: DataFrame, table: str, home: str) -> None:
        """A table by date that has no row yet has no file either: an empty one tells its columns."""
        if table in FACT_TIMES and self._part(home, "") is None and self._part(home, _DATE) is None and self._part(home, _RUN) is None:
            dated(df, table).limit(0).write.format(self.fmt).mode("append").save(home)

    def append_if_any(self, df: DataFrame, table: str, run_id: str | None = None, rows: int | None = None) -> bool:
        """Append unless there are no rows; says whether it wrote. ``rows``: how many there are, where that is known."""
        if df.isEmpty() if rows is None else not rows:
            return False
        self.append(df, table, run_id)
        return True

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        target = f"{self.home(table)}/{_BATCH}={batch_id}"
        df.write.format(self.fmt).mode("overwrite").save(target)

    def replace(self, df: DataFrame, table: str) -> None:
        version = (self.version(table) or 0) + 1
        self._writer(df, table, "overwrite").save(self._slot(table, version))
        self._keep_schema(df, table, self._slot(table, version))
        self._name_version(table, version)

    def batches(self, table: str, after: int, before: int) -> DataFrame | None:
        """The micro-batches between two ids, without a look at the folders of others."""
        ids = ",".join(str(i) for i in range(after + 1, before))
        home = self.home(table)
        parts = [self._load(f"{home}/{_BATCH}={{{ids}}}", base=home) if ids else None, self._part(home, "")]
        if parts[1] is not None:  # batches that were compacted
            known = _BATCH in parts[1].columns
            parts[1] = parts[1].where((F.col(_BATCH) > after) & (F.col(_BATCH) < before)) if known else None
        parts = [p for p in parts if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def compact_batches(self, table: str) -> int:
        """Gather the folders of all micro-batches but the last into few files; returns how many there were.

        The last batch keeps its folder, as it may come again. Call it while no stream writes to the table, or from
        the stream's own batch function. Readers see the table as it was until the new version is named.
        """
        home = self.home(table)
        ids = sorted(int(n.rsplit("=", 1)[1]) for n in self._names(f"{home}/{_BATCH}=*"))
        if len(ids) < 2:
            return 0
        version = (self.version(table) or 0) + 1
        slot, rows = self._slot(table, version), self.scan(table)
        rows.where(F.col(_BATCH).isNull() | (F.col(_BATCH) < ids[-1])).hint("rebalance").write.format(self.fmt).mode("overwrite").save(slot)
        last = self._load(f"{home}/{_BATCH}={ids[-1]}")
        if last is not None:
            last.write.format(self.fmt).mode("overwrite").save(f"{slot}/{_BATCH}={ids[-1]}")
        self._name_version(table, version)
        if home == self.path(table):
            remove_folders(self.spark, self._names(f"{home}/{_BATCH}=*"))
        return len(ids) - 1

    def buckets(self, table: str, wanted: list[int] | None = None) -> DataFrame | None:
        """The rows of a table that ``replace_buckets`` wrote, of all its buckets or of some."""
        version = self.version(table)
        if version is None:
            return None
        live: dict[str, tuple[int, str]] = {}
        for path in self._names(f"{self.path(table)}/{_BUCKET}=*/{_VERSION}=*"):
            bucket, number = path.rsplit("/", 2)[1], int(path.rsplit("=", 1)[1])
            if number <= version and (wanted is None or int(bucket.split("=")[1]) in wanted):
                live[bucket] = max(live.get(bucket, (-1, "")), (number, path))
        if not live:
            return None
        return self._load(*[path for _, path in live.values()], base=self.path(table)).drop(_BUCKET, _VERSION)

    def replace_buckets(self, df: DataFrame, table: str, version: int) -> None:
        """Write new contents of the buckets that occur in the column ``bucket``; the others keep their files.

        The new contents lie beside the old ones until the version is named, so a reader sees a version as a whole,
        and a write that failed can come again. Of each bucket the contents before the old ones are removed.
        """
        home, before = self.path(table), self.version(table)
        rows = df.withColumn(_VERSION, F.lit(version))
        # A bucket's rows come from one task of the aggregation or join before; the hint gathers what does not.
        rows.hint("rebalance", _BUCKET).write.format(self.fmt).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(_BUCKET, _VERSION).save(home)
        self._name_version(table, version)
        old: dict[str, list[tuple[int, str]]] = {}
        for path in self._names(f"{home}/{_BUCKET}=*/{_VERSION}=*"):
            number = int(path.rsplit("=", 1)[1])
            if before is not None and number <= before:
                old.setdefault(path.rsplit("/", 2)[1], []).append((number, path))
        remove_folders(self.spark, [path for found in old.values() for _, path in sorted(found)[:-1]])

    def replace_dates(self, df: DataFrame, table: str) -> None:
        """Put these rows in place of the stored rows of their dates; other dates keep their files.

        The table has to be stored by date alone: rows of single runs would stay beside the replaced ones.
        """
        home = self.home(table)
        for kind in self._kinds(home) - {_DATE}:
            rows = self._part(home, kind)
            if rows is not None and not rows.isEmpty():
                raise ValueError(f"table {table} has rows that are not stored by date alone")
        with work_scope(self.spark):
            rows = staged(df, "dates")  # they may come from the folders they replace
            self._writer(rows, table, "overwrite").option("partitionOverwriteMode", "dynamic").save(home)
            self._keep_schema(rows, table, home)


class CatalogStore:
    """Tables of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark, self.database = spark, database

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def find(self, table: str) -> DataFrame | None:
        return self.scan(table) if self.spark.catalog.tableExists(self.name(table)) else None

    def scan(self, table: str) -> DataFrame:
        return self.spark.read.table(self.name(table))

    def append(self, df: DataFrame, table: str, run_id: str | None = None) -> None:
        """Add rows. A table is written with run ids always or never, as these are its partitions."""
        if run_id is None:
            df.write.mode("append").saveAsTable(self.name(table))
        else:
            self._write_partition(df, table, _RUN, F.lit(run_id), "'" + run_id.replace("\\", "\\\\").replace("'", "\\'") + "'")

    append_if_any = FolderStore.append_if_any

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        """Write a micro-batch as one partition, replacing the same batch of an earlier try."""
        self._write_partition(df, table, _BATCH, F.lit(batch_id).cast("bigint"), str(int(batch_id)))

    def _write_partition(self, df: DataFrame, table: str, column: str, value: Column, literal: str) -> None:
        if self.find(table) is None:
            df.withColumn(column, value).write.partitionBy(column).saveAsTable(self.name(table))
            return
        columns = [c for c in self.scan(table).columns if c != column]
        self.spark.sql(
            f"INSERT OVERWRITE {self.name(table)} PARTITION ({column} = {literal}) SELECT * FROM {{rows}}",
            rows=df.select(*columns),
        )

    def replace(self, df: DataFrame, table: str) -> None:
        """Rewrite a table, also from its own rows: the new rows are written as a table beside it, which takes its name
        when it is complete. The old rows are dropped last."""
        new, old = f"{self.name(table)}__new", f"{self.name(table)}__old"
        df.write.mode("overwrite").saveAsTable(new)
        if self.find(table) is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
            self.spark.sql(f"ALTER TABLE {self.name(table)} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {new} RENAME TO {self.name(table)}")
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")


class JdbcStore:
    """Tables of a database; ``options`` carry the URL, driver and credentials from the caller."""

    def __init__(
        self, spark: SparkSession, options: dict[str, str], stage: FolderStore,
        splits: dict[str, dict[str, str]] | None = None,
    ):
        """``splits``: for large tables, Spark's partitionColumn, lowerBound, upperBound and numPartitions."""
        self.spark, self.options, self.stage, self.splits = spark, options, stage, splits or {}

    def _load(self, source: str, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options, **options).option("dbtable", source).load()

    def scan(self, table: str) -> DataFrame:
        return self._load(table, **self.splits.get(table, {}))

    def find(self, table: str) -> DataFrame | None:
        """The table's rows, or None when the database's information schema does not name it."""
        names = self._load("(SELECT table_name AS found FROM information_schema.tables) known")
        return None if names.where(F.col("found") == table.split(".")[-1]).isEmpty() else self.scan(table)

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        writer = df.write.format("jdbc").options(**self.options).option("dbtable", table)
        writer.option("truncate", "true").mode(mode).save()

    def append(self, df: DataFrame, table: str, run_id: str | None = None) -> None:
        """Append; rows of a run that comes again are told apart by nothing but the run id."""
        self._write(df if run_id is None else df.withColumn(_RUN, F.lit(run_id)), table, "append")

    append_if_any = FolderStore.append_if_any

    def write_batch(self, df: DataFrame, table: str, batch_id: int) -> None:
        """Append with the batch id; a replayed batch is told apart by that column."""
        self.append(df.withColumn(_BATCH, F.lit(batch_id).cast("bigint")), table)

    def replace(self, df: DataFrame, table: str) -> None:
        """Stage the rows in the shared folder, since they may come from the table itself."""
        self.stage.replace(df, table)
        self._write(self.stage.scan(table), table, "overwrite")


TableStore = FolderStore | CatalogStore | JdbcStore
