"""Chat formatting with column expressions only.

A row of a table that was read from mixed records has nulls where its record had no such field. The sorted list of
the nested paths it does have is its schema; the hash of that list is looked up among those of declared layouts, and
the layout says how its fields become turns. Turns are then written in one template and can be read back from it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

TURNS = "array<struct<role:string,text:string>>"

HEAD, HEAD_END, TURN_END = "<|", "|>\n", "</s>\n"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Turn:
    """One turn: ``role`` is a field if it starts with a dot, else the role itself; ``texts`` are joined by blank lines."""

    role: str
    texts: tuple[str, ...]


@dataclass(frozen=True)
class Layout:
    """Which nested paths a record has, and how they become turns. ``each`` names an array of turn records."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Turn, ...]
    each: str | None = None

    def paths(self) -> set[str]:
        return {*self.required, *self.optional}

    def schemas(self) -> list[tuple[str, ...]]:
        """The lists of paths that records of this layout may have."""
        return [
            tuple(sorted({*self.required, *chosen}))
            for n in range(len(self.optional) + 1)
            for chosen in combinations(self.optional, n)
        ]


LAYOUTS = (
    Layout("turn", (), ("role", "text"), (Turn(".role", ("text",)),)),
    Layout("messages", (), ("messages[].role", "messages[].content"), (Turn(".role", ("content",)),), "messages"),
    Layout("conversations", (), ("conversations[].from", "conversations[].value"), (Turn(".from", ("value",)),), "conversations"),
    Layout("instruction", ("instruction",), ("system", "input", "output"),
           (Turn("system", ("system",)), Turn("user", ("instruction", "input")), Turn(ASSISTANT, ("output",)))),
    Layout("prompt", ("prompt",), ("system", "response"),
           (Turn("system", ("system",)), Turn("user", ("prompt",)), Turn(ASSISTANT, ("response",)))),
    Layout("completion", ("prompt", "completion"), ("system",),
           (Turn("system", ("system",)), Turn("user", ("prompt",)), Turn(ASSISTANT, ("completion",)))),
)

#: Names that sources give the roles of message arrays.
ROLE_NAMES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


def leaf_paths(schema: T.StructType, ignore: tuple[str, ...] = ()) -> dict[str, Column]:
    """The nested paths of a schema, ``[]`` for array items, and whether a row has them."""
    out: dict[str, Column] = {}

    def walk(kind: T.DataType, path: str, present) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}", lambda test, f=f: present(lambda v: test(v[f.name])))
        elif isinstance(kind, T.ArrayType):
            walk(kind.elementType, f"{path}[]", lambda test: present(lambda v: F.coalesce(F.exists(v, test), F.lit(False))))
        else:
            out[path] = present(lambda v: v.isNotNull())

    for field in schema.fields:
        if field.name not in ignore:
            walk(field.dataType, field.name, lambda test, field=field: test(F.col(f"`{field.name}`")))
    return out


def _hash(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit("\n".join(paths)))


def fingerprint(present: dict[str, Column]) -> Column:
    """The hash of the sorted paths that a row has."""
    names = F.array(*(F.when(test, F.lit(path)) for path, test in sorted(present.items())))
    return F.xxhash64(F.array_join(F.array_compact(names), "\n"))


def _turn(turn: Turn, field, have: set[str]) -> Column | None:
    """The turn as a struct, null if its record has none of its texts but the layout could have them."""
    texts = [field(t) for t in turn.texts if t in have] or [F.lit(None).cast("string")] * turn.role.startswith(".")
    if not texts:
        return None
    role = field(turn.role[1:]) if turn.role.startswith(".") and turn.role[1:] in have else F.lit(None if turn.role.startswith(".") else turn.role)
    text = F.array_join(F.array_compact(F.array(*texts)), "\n\n")
    made = F.struct(role.cast("string").alias("role"), text.alias("text"))
    if turn.role.startswith("."):
        return made  # a record is a turn, with or without text
    return F.when(reduce(lambda a, b: a | b, [t.isNotNull() for t in texts]), made)


def _item_turn(turn: Turn, have: set[str]):
    """A function from an item of a layout's array to its turn, under the usual role names."""
    names = F.create_map(*(F.lit(k) for pair in ROLE_NAMES.items() for k in pair))

    def made(item: Column) -> Column:
        found = _turn(turn, lambda f: item[f], have)
        known = F.element_at(names, F.coalesce(F.lower(found["role"]), F.lit("")))
        return F.struct(F.coalesce(known, found["role"]).alias("role"), found["text"].alias("text"))

    return made


def canonical(df: DataFrame, ignore: tuple[str, ...], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` and ``turns`` in place of the record's fields; ``ignore`` names the other columns.

    A layout takes part if the table has all its required paths and one path at least; where two declare the same
    schema, the first counts. Fields that no layout takes part with (of other types, or clashing) are no part of a
    fingerprint if no layout names them; rows whose paths fit none have null in both columns.
    """
    present = leaf_paths(df.schema, ignore)
    named = set().union(*(x.paths() for x in layouts))
    present = {p: c for p, c in present.items() if p in named}
    usable = [x for x in layouts if set(x.required) <= set(present) and x.paths() & set(present)]
    chosen, turns, taken = F.lit(None).cast("string"), F.lit(None).cast(TURNS), set()
    cases: list[tuple[str, Column, Column]] = []
    for layout in usable:
        schemas = [s for s in layout.schemas() if set(s) <= set(present) and s not in taken]
        taken.update(schemas)
        if layout.each:
            prefix = f"{layout.each}[]."
            have = {p.removeprefix(prefix) for p in present if p.startswith(prefix)}
            made = F.transform(F.col(layout.each), _item_turn(layout.turns[0], have))
        else:
            parts = [t for t in (_turn(x, F.col, set(present)) for x in layout.turns) if t is not None]
            made = F.array_compact(F.array(*parts))
        if schemas:
            cases.append((layout.name, reduce(lambda a, b: a | b, [F.col("fingerprint") == _hash(s) for s in schemas]), made.cast(TURNS)))
    for name, test, made in reversed(cases):
        chosen, turns = F.when(test, F.lit(name)).otherwise(chosen), F.when(test, made).otherwise(turns)
    marked = df.withColumn("fingerprint", fingerprint(present))
    return marked.select(*ignore, "fingerprint", chosen.alias("layout"), turns.alias("turns"))


# A control string is a character followed by the rest of it. Inside texts a backslash is put between the two, after
# any backslashes' place: n backslashes there become n + 1, so that taking one away restores every text.
_CONTROL = ((r"<", r"(?:\||/?s>|/?SYS>>)"), (r"\[", r"/?INST\]"), (r"\|", r">"))
_ESCAPE = "|".join(rf"(?<={first})(?=\\*{rest})" for first, rest in _CONTROL)
_UNESCAPE = "|".join(rf"(?<={first})\\(?=\\*{rest})" for first, rest in _CONTROL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit(""))


def formatted(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each ``key``: its turns (columns role, text) in order, in one template, with the loss mask.

    ``formatted`` has ``<|role|>``, a line end, the text and ``</s>`` with a line end for each turn. ``loss_spans``
    are the assistant's texts in it, in code points: turn number, start of the turn, start and end of the text.

    Null roles and texts are empty. Turns of equal order are put by role and text; repeated rows are repeated turns. Null
    keys are one conversation. A conversation is one value of the result, so its turns meet in one task; formatting is
    done before that, row by row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEAD), escaped(role), F.lit(HEAD_END))
    rows = turns.select(key, *order, role.alias("role"), text.alias("text"), head.alias("head"), escaped(text).alias("body"))
    rows = rows.select(key, *order, "role", "text", F.concat("head", "body", F.lit(TURN_END)).alias("chunk"),
                       F.length("head").cast("long").alias("head_length"), F.length("body").cast("long").alias("body_length"))
    by = Window.partitionBy(key).orderBy(*order, "role", "text")
    placed = rows.select(
        key, "chunk", (F.col("role") == ASSISTANT).alias("learn"), "head_length", "body_length",
        F.row_number().over(by).alias("turn"),
        F.coalesce(F.sum(F.length("chunk").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("at"),
    )
    whole = placed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("turn", "at", "chunk", "learn", "head_length", "body_length"))).alias("t"))
    start = lambda t: t["at"] + t["head_length"]
    spans = F.transform(F.filter("t", lambda t: t["learn"]), lambda t: F.struct(
        t["turn"].alias("turn"), t["at"].alias("turn_start"), start(t).alias("start"), (start(t) + t["body_length"]).alias("end")))
    return whole.select(key, F.array_join(F.transform("t", lambda t: t["chunk"]), "").alias("formatted"), spans.alias("loss_spans"))


def parsed(formatted_rows: DataFrame, key: str) -> DataFrame:
    """The turns of ``formatted`` again: ``segments`` as they stand, ``turns`` unescaped, ``loss`` the text under the mask."""
    cut = F.split("formatted", TURN_END)
    rows = formatted_rows.select(key, "formatted", "loss_spans", F.slice(cut, 1, F.size(cut) - 1).alias("segments"))

    def turn(segment: Column) -> Column:
        end = F.instr(segment, HEAD_END)
        return F.struct(
            unescaped(F.substring(segment, F.lit(1 + len(HEAD)), end - 1 - len(HEAD))).alias("role"),
            unescaped(F.substring(segment, end + len(HEAD_END), F.length(segment))).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescaped(F.substring(
        F.element_at("segments", s["turn"]), (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return rows.select(key, "formatted", "loss_spans", "segments", F.transform("segments", turn).alias("turns"), F.array_join(masked, "").alias("loss"))
