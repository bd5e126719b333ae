"""Secret scan: fixed patterns, and windows of high entropy in the runs of each character class."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from playtide.llm.common import as_strings, give_back, slices

SPANS = "array<struct<kind:string,start:int,end:int>>"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")


@dataclass(frozen=True)
class CharClass:
    """Candidates are runs of ``alphabet``; a window of ``window`` characters is a secret from ``bits`` of entropy
    a character on, if it has characters of each of ``needs``, of the first of them ``fewest`` at least."""

    alphabet: str
    window: int
    bits: float
    needs: tuple[str, ...] = ()
    fewest: int = 1


#: A window of 24 hex digits has 4 bits at most, random ones about 3.4; one of 20 base-64 characters log2(20) = 4.3
#: at most, random ones about 4.0, and words written together about 3.2. Windows of 24 digits and letters of one case
#: have log2(24) = 4.6 at most, random ones about 4.0 with 4 to 7 digits, and words with a year in them up to 3.9.
CLASSES = (
    CharClass("0-9a-fA-F", 24, 3.0, ("0-9", "a-fA-F")),
    CharClass("A-Za-z0-9", 20, 3.6, ("0-9", "a-z", "A-Z")),
    CharClass("A-Za-z0-9+/_=-", 24, 3.8, ("0-9", "a-z", "A-Z")),
    CharClass("a-z0-9", 24, 3.8, ("0-9", "a-z"), 5),
    CharClass("A-Z0-9", 24, 3.8, ("0-9", "A-Z"), 3),
)

#: Whole runs that look random and are not secret: UUIDs, paths and hyphenated or snake-case words.
ALLOWED = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"/?(?:[A-Za-z]+|[0-9]{1,4})(?:[/_-](?:[A-Za-z]+|[0-9]{1,4}))+/?",
)

_ROWS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
#: What no secret holds: eight characters on of an alphabet or of the digits, and the mark of documentation. A window
#: around one is not reported; the rest of its run may be.
ALLOWED_INSIDE = (*(row[k : k + 8] for row in _ROWS for k in range(len(row) - 7)), "EXAMPLE")

#: Published example keys.
ALLOWED_TEXTS = frozenset(["wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"])


def entropy_windows(
    run: str, window: int, bits: float, needs: tuple[frozenset, ...] = (), allowed: list[tuple[int, int]] | None = None,
    fewest: int = 1,
) -> list[tuple[int, int]]:
    """Maximal stretches of ``run`` that are covered by windows of at least ``bits`` a character.

    ``allowed``: stretches, in order of their starts, that clear each window they lie in.

    Shannon entropy of a window of w characters is log2(w) - sum(c * log2(c)) / w over the counts c. Moving on by
    one character changes two counts, so the sum is carried along; it is kept in whole multiples of 2**-40 so that
    nothing accumulates.
    """
    if len(run) < window:
        return []
    term = [0] + [round(c * math.log2(c) * (1 << 40)) for c in range(1, window + 1)]
    most = math.floor((math.log2(window) - bits) * window * (1 << 40))  # of the sum, to reach the entropy
    counts: dict[str, int] = {}
    total, have = 0, [0] * len(needs)
    spans: list[tuple[int, int]] = []
    # For each start the first end of an allowed stretch that begins there or later.
    clear, first = [len(run) + 1] * (len(run) + 1) if allowed else None, len(run) + 1
    ends = dict(sorted(allowed or [], reverse=True))
    for i in range(len(run), -1, -1) if clear else ():
        first = clear[i] = min(first, ends.get(i, first))
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        total += term[n + 1] - term[n]
        counts[c] = n + 1
        for k, chars in enumerate(needs):
            have[k] += c in chars
        if i >= window:
            gone = run[i - window]
            n = counts[gone]
            total += term[n - 1] - term[n]
            counts[gone] = n - 1
            for k, chars in enumerate(needs):
                have[k] -= gone in chars
        if i >= window - 1 and total <= most and all(have) and (not have or have[0] >= fewest):
            start = i + 1 - window
            if clear and clear[start] <= i + 1:
                continue
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """Spans of one text, in code points, by start and then kind in the order of ``KINDS``."""

    def __init__(self, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
                 allowed_inside: tuple[str, ...] = ALLOWED_INSIDE, allowed_texts: frozenset[str] = ALLOWED_TEXTS):
        def expand(chars: str) -> frozenset[str]:
            return frozenset(re.findall(f"[{chars}]", "".join(map(chr, range(128)))))

        self.classes = [
            (re.compile(f"[{c.alphabet}]{{{c.window},}}"), c.window, c.bits, tuple(expand(n) for n in c.needs), c.fewest)
            for c in classes
        ]
        self.allowed = re.compile("|".join(f"(?:{a})" for a in allowed)) if allowed else None
        # A lookahead finds overlapping ones; of those that begin together the first named counts.
        self.inside = re.compile("(?=(" + "|".join(map(re.escape, allowed_inside)) + "))") if allowed_inside else None
        self.allowed_texts = allowed_texts

    def base(self, text: str) -> list[tuple[int, int, int]]:
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        return found

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind number, end): the base spans, and high-entropy spans that no base span has whole."""
        base = self.base(text)
        windows: list[tuple[int, int]] = []
        for pattern, window, bits, needs, fewest in self.classes:
            for m in pattern.finditer(text):
                if m[0] in self.allowed_texts or self.allowed is not None and self.allowed.fullmatch(m[0]):
                    continue
                clear = [i.span(1) for i in self.inside.finditer(m[0])] if self.inside is not None else []
                windows += [(m.start() + a, m.start() + b) for a, b in entropy_windows(m[0], window, bits, needs, clear, fewest)]
        merged: list[list[int]] = []
        for a, b in sorted(windows):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        new = [(a, 3, b) for a, b in merged if not any(s <= a and b <= e for s, _, e in base)]
        return sorted(base + new)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by the mark."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def secrets(text: Column, **rules) -> Column:
    """The spans of each text as an array of (kind, start, end), ends exclusive, in code points.

    A null or empty text has none. ``rules`` are those of :class:`Scanner`: character classes, allow-list patterns
    of whole candidate runs, strings that clear the windows they lie in, and whole runs by their text. Allow-lists
    act on the entropy spans only; base spans always stay. Equal texts give equal spans; other columns play no part.
    """

    @F.arrow_udf(SPANS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(**rules)
        names = np.array(KINDS, object)
        for texts in batches:
            found = [scanner.scan(t) for piece in slices(texts) for t in as_strings(piece)]
            flat = [s for spans in found for s in spans]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            parts = pa.StructArray.from_arrays(
                [
                    pa.array(names[[k for _, k, _ in flat]] if flat else [], pa.string()),
                    pa.array([s for s, _, _ in flat], pa.int32()),
                    pa.array([e for _, _, e in flat], pa.int32()),
                ],
                names=["kind", "start", "end"],
            )
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)
        give_back()

    return run(text)


def redact(text: Column, mark: str = "[SECRET]", **rules) -> Column:
    """Each text with its secrets replaced by ``mark``; a text without any is unchanged, a null stays null."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(**rules)
        for texts in batches:
            out: list[str | None] = []
            for piece in slices(texts):
                out += [t and redacted(t, scanner.scan(t), mark) for t in piece.to_pylist()]
            yield pa.array(out, pa.string())
        give_back()

    return run(text)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
