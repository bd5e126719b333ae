"""JSON event files whose objects stand back-to-back, on lines of their own, or both."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from playtide.schemas import EVENT
from playtide.session import configure

#: The longest piece of a log between two cuts that a task takes.
PIECE_BYTES = 32 * 1024 * 1024

_SPACE = " \t\r\n"


def records_of_line(line: Column) -> Column:
    """The JSON objects of one text line: a record also ends between ``}`` and ``{``.

    Blank records are left out. A line with one object is taken as it is.
    """
    parted = F.replace(line, F.lit("}{"), F.lit("}\n{"))
    several = _nonblank(F.split(parted, "\n"))
    alone = F.when(F.trim(line, F.lit(_SPACE)) == "", _no_records()).otherwise(F.array(line))
    return F.when(line.contains("}{"), several).otherwise(alone)


def records_of_chunk(chunk: Column) -> Column:
    """The JSON objects of one piece of a text that was cut at every ``}{``.

    The cut took one closing and one opening brace. An object's text cannot start with a brace
    after its own, so a chunk that does is the first of its file. After the last object of a
    file the restored closing brace is one too many: the JSON parser ignores it, and it is dropped
    where it stands alone on a line. A chunk without a line end is one record as it is.
    """
    bare = F.ltrim(chunk, F.lit(_SPACE))
    opened = F.when(bare.startswith("{"), chunk).otherwise(F.concat(F.lit("{"), chunk))
    whole = F.concat(opened, F.lit("}"))
    several = _nonblank(F.split(F.regexp_replace(whole, r"(\n\s*)\}$", "$1"), "\n"))
    blank = (bare == "") & (chunk != "")
    return F.when(blank, _no_records()).when(chunk.contains("\n"), several).otherwise(F.array(whole))


def _nonblank(records: Column) -> Column:
    return F.filter(records, lambda r: F.trim(r, F.lit(_SPACE)) != "")


def _no_records() -> Column:
    return F.array().cast("array<string>")


def parse_records(
    text: DataFrame, records: Column, schema: T.StructType = EVENT, corrupt: str | None = None
) -> DataFrame:
    """One row per record, with the columns of ``schema``; malformed ones give nulls.

    With ``corrupt`` a column of that name holds the text of malformed records. Records are parsed
    inside the explode, so a later filter on their fields does not parse them a second time.
    """
    options = {}
    if corrupt is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options = {"columnNameOfCorruptRecord": corrupt}
    parsed = F.transform(records, lambda r: F.from_json(r, schema, options))
    events = text.select(F.explode(parsed).alias("e"))
    return events.select(*[F.col("e").getField(name).alias(name) for name in schema.names])


#: Bytes at the start of a file from which its layout is told.
HEAD_BYTES = 64 * 1024
_READERS = 32

_AT_ONCE, _APART = re.compile(rb"\}\{"), re.compile(rb"\}[ \t\r\n]+\{")


def layout_of(head: bytes) -> str:
    """``packed`` where more records follow a ``}`` at once than after white space."""
    return "packed" if len(_AT_ONCE.findall(head)) > len(_APART.findall(head)) else "lines"


def measured_layouts(spark: SparkSession, path: str | list[str], head_bytes: int = HEAD_BYTES) -> dict[str, str]:
    """The layout of each file, from its first ``head_bytes`` bytes (after decompression).

    The files are listed, not scanned: whatever their size, so many bytes of each are read. The driver does this, as it
    lists all files anyway, with several readers at a time. A file whose first record is longer than that
    is taken as ``lines``; the limit on pieces tells where that was wrong.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    names = [row["path"] for row in spark.read.format("binaryFile").load(path).select("path").toLocalIterator()]

    def layout(name: str) -> str:
        file = hadoop.fs.Path(name)
        stream, codec = file.getFileSystem(conf).open(file), codecs.getCodec(file)
        try:
            return layout_of(bytes((codec.createInputStream(stream) if codec else stream).readNBytes(head_bytes)))
        finally:
            stream.close()

    with ThreadPoolExecutor(_READERS) as readers:
        return dict(zip(names, readers.map(layout, names), strict=True))


def _bounded(row: Column, layout: str, limit_bytes: int) -> Column:
    """The text row, or an error where it is longer than a task should hold."""
    other = "lines" if layout == "packed" else "packed"
    message = F.concat(
        F.lit("a piece of "), F.octet_length(row).cast("string"),
        F.lit(f" bytes without a cut: layout='{layout}' does not fit this log, try '{other}' or 'measured'"),
    )
    return F.when(F.octet_length(row) > limit_bytes, F.raise_error(message).cast("string")).otherwise(row)


def read_packed_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = EVENT,
    layout: str = "packed",
    corrupt: str | None = None,
    limit_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Read an event log.

    Both layouts accept objects back-to-back and on lines. They differ in where a file is cut for
    parallel reading: ``packed`` between ``}`` and ``{``, so a file of many gigabytes on one line
    splits over many tasks; ``lines`` at line ends. A piece of over ``limit_bytes`` fails the query: its file has
    the other layout and would end in one task. ``measured`` looks at the start of every file first and reads each by
    its own layout. For files with just one object per line
    ``read_json`` is the fastest. Only ``lines`` notices when the very last object
    of a file lacks just its closing brace; ``packed`` reads that one as complete.
    """
    configure(spark)
    if layout == "measured":
        files: dict[str, list[str]] = {}
        for file, kind in measured_layouts(spark, path).items():
            name = re.sub(r"([\[\]{}*?\\])", r"\\\1", file)  # as a path pattern for this file alone
            files.setdefault(kind, []).append(name)
        parts = [
            read_packed_json(spark, path if len(files) == 1 else names, schema, kind, corrupt, limit_bytes)
            for kind, names in sorted(files.items())
        ] or [read_packed_json(spark, path, schema, "lines", corrupt, limit_bytes)]
        return reduce(DataFrame.unionByName, parts)
    if layout not in ("packed", "lines"):
        raise ValueError("layout must be 'packed', 'lines' or 'measured'")
    rows = spark.read.option("lineSep", "}{" if layout == "packed" else "\n").text(path)
    rows = rows.select(_bounded(F.col("value"), layout, limit_bytes).alias("value"))
    records = records_of_chunk if layout == "packed" else records_of_line
    return parse_records(rows, records(F.col("value")), schema, corrupt)


def read_json(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> DataFrame:
    """Newline-delimited JSON with a fixed schema; partition folders become columns."""
    configure(spark)
    return spark.read.schema(schema).json(path)
