"""Expressions over event fields, arrays and key-value text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from playtide.schemas import ACTION_NAMES


def sorted_join(items: Column, separator: str = ",") -> Column:
    """Array items in ascending order as one string; null items are left out."""
    return F.array_join(F.array_sort(items), separator)


def action_name(code: Column) -> Column:
    """Name of an action code, null when the code is unknown."""
    pairs = [F.lit(part) for entry in ACTION_NAMES.items() for part in entry]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def key_values(text: Column, pair_separator: str = "&", key_separator: str = "=") -> Column:
    """``a=1&b=2`` as a map; the last of several equal keys wins."""
    pairs = F.transform(
        F.split(text, re.escape(pair_separator)),
        lambda pair: F.split(pair, re.escape(key_separator)),
    )
    entries = F.transform(
        pairs, lambda p: F.struct(p[0].alias("key"), F.get(p, F.lit(1)).alias("value"))
    )

    # Sorted by key and place, an entry is its key's last one when the next entry has another key.
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(
        e["key"].alias("key"), i.alias("place"), e["value"].alias("value"))))

    def last_of_each_key(ordered: Column) -> Column:
        last = F.filter(ordered, lambda e, i: ~F.get(ordered, i + 1)["key"].eqNullSafe(e["key"]))
        in_place = F.array_sort(F.transform(last, lambda e: F.struct(
            e["place"].alias("place"), e["key"].alias("key"), e["value"].alias("value"))))
        return F.transform(in_place, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

    # One-element array: the entries are sorted once and then looked at twice.
    return F.map_from_entries(F.transform(F.array(placed), last_of_each_key)[0])


def last_part_matching(fields: Column, suffix: str) -> Column:
    """Value of the first map entry whose key ends with ``suffix``."""
    matching = F.filter(F.map_entries(fields), lambda e: e["key"].endswith(suffix))
    return F.get(matching, F.lit(0)).getField("value")


def row_digest(*columns: str) -> Column:
    """128-bit hex digest of a row's values, the same in every run and every retry.

    Each value is preceded by its length, so no two different rows give the same text.
    """
    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.when(text.isNull(), "n").otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.md5(F.concat(*[part(c) for c in columns]))


def add_row_id(df: DataFrame, name: str, mode: str = "digest") -> DataFrame:
    """Add a unique row id.

    ``digest`` is a stable 128-bit hex string, ``hash`` a stable bigint (64 bits: expect
    collisions above some billions of rows), ``sequence`` a bigint unique in one run only.
    """
    if mode == "digest":
        return df.withColumn(name, row_digest(*df.columns))
    if mode == "hash":
        return df.withColumn(name, F.xxhash64(*df.columns))
    if mode == "sequence":
        return df.withColumn(name, F.monotonically_increasing_id())
    raise ValueError("mode must be 'digest', 'hash' or 'sequence'")


def drop_nested(df: DataFrame, path: str) -> DataFrame:
    """Drop a field by dotted path, through structs and arrays of structs.

    A path that names no field leaves the frame as it is. Arrays keep their shape.
    """
    top, *rest = path.split(".")
    if top not in df.columns:
        return df
    if not rest:
        return df.drop(top)
    return df.withColumn(top, _without(F.col(top), df.schema[top].dataType, rest))


def _without(column: Column, kind: T.DataType, path: list[str]) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda item: _without(item, kind.elementType, path))
    if not isinstance(kind, T.StructType) or path[0] not in kind.names:
        return column
    if len(path) == 1:
        return column.dropFields(path[0])
    inner = _without(column.getField(path[0]), kind[path[0]].dataType, path[1:])
    return column.withField(path[0], inner)
