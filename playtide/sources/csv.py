"""Typed CSV files, wide rate sheets, zipped sheets and key-value files."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

LINES_PER_BATCH = 10_000


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ","
) -> DataFrame:
    """CSV with a fixed schema; a quote inside a quoted value is doubled."""
    options = {"header": header, "sep": sep, "escape": '"'}
    return spark.read.schema(schema).options(**options).csv(path)


def read_wide_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV whose columns are known only from its header, all read as text."""
    return spark.read.options(header=header, sep=sep).csv(path)


def archive_lines(archives: DataFrame) -> DataFrame:
    """Text lines of zip archives given as ``path, content``: path, entry, line_no, line.

    An archive must hold exactly one file; anything else fails the query.
    """

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import itertools
        import zipfile

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    entries = [e for e in archive.infolist() if not e.is_dir()]
                    if len(entries) != 1:
                        raise ValueError(f"{path} holds {len(entries)} files, not one")
                    with archive.open(entries[0]) as raw:
                        numbered = enumerate(io.TextIOWrapper(raw, encoding="utf-8-sig"))
                        while some := list(itertools.islice(numbered, LINES_PER_BATCH)):
                            yield pd.DataFrame({
                                "path": path,
                                "entry": entries[0].filename,
                                "line_no": [n for n, _ in some],
                                "line": [text.rstrip("\r\n") for _, text in some],
                            })

    return archives.select("path", "content").mapInPandas(
        unzip, "path string, entry string, line_no bigint, line string"
    )


def lines_to_wide(lines: DataFrame, header: bool = True, sep: str = ",") -> DataFrame:
    """Wide text columns from archive lines; all archives must share one header line.

    Without a header the first column is taken as the date and the others have no usable name.
    """
    first = lines.where(F.col("line_no") == 0).select("line").distinct().limit(2).collect()
    if len(first) != 1:
        raise ValueError("the archives do not share one header line")
    cells = next(csv.reader([first[0]["line"]], delimiter=sep))  # a quoted title may hold the separator
    titles = [c if header else f"_c{i}" for i, c in enumerate(cells)]
    names = [t if t.strip() else f"_c{i}" for i, t in enumerate(titles)]
    body = lines.where(F.col("line_no") > 0) if header else lines
    schema = ", ".join(f"f{i} string" for i in range(len(names)))
    parsed = body.where(F.trim("line") != "").select(F.from_csv("line", schema, {"sep": sep, "escape": '"'}).alias("r"))
    return parsed.select(*[F.col(f"r.f{i}").alias(n) for i, n in enumerate(names)])


def read_zipped_csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    archives = spark.read.format("binaryFile").load(path)
    return lines_to_wide(archive_lines(archives), header, sep)


def key_value_lines(lines: DataFrame, order: Column) -> DataFrame:
    """``key,value`` lines as ``id, name``; of equal keys the last in ``order`` wins.

    Further commas and what follows them are ignored, lines without a comma are skipped.
    """
    parts = F.split("value", ",")
    rows = lines.select(
        F.get(parts, F.lit(0)).alias("id"), F.get(parts, F.lit(1)).alias("name"), order.alias("at")
    ).where(F.col("name").isNotNull())
    return rows.groupBy("id").agg(F.max_by("name", "at").alias("name"))


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    order = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    lines = spark.read.text(path)
    return key_value_lines(lines.select("value", order.alias("at")), F.col("at"))
