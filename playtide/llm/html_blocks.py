"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks of text. Each block has a vector of hashed tag-path tokens, of its parent's tokens, of
hashed words and of a few sizes; a bidirectional LSTM in numpy reads the vectors of the whole page and says for each
block whether it belongs to the article. The weights come from ``train_blocks``.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from playtide.llm.common import as_strings, slices

PATH_DIMS, WORD_DIMS, SIZES, HIDDEN = 96, 24, 8, 16
INPUTS = 2 * PATH_DIMS + WORD_DIMS + SIZES
WEIGHTS = Path(__file__).with_name("block_weights.npz")
#: Blocks of pages that are labelled in one pass; a page with more is a pass of its own.
PASS_BLOCKS = 20_000

#: Elements whose contents are no markup: they run to their end tag, or to the end of the page.
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
#: Elements whose contents are no text of a page as long as they are open. One that is not closed ends with the block
#: it stands in. What ``math``, ``noscript`` and ``object`` hold is for the labeller to judge.
SKIPPED = frozenset("template select button svg canvas audio video annotation".split())
#: Of these one may stand in another.
NESTED = frozenset(["svg", "template"])
#: What begins a part of the page of its own.
SECTIONS = frozenset("article aside blockquote body dl footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext "
    "munder munderover semantics".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: np.ndarray
    parent: np.ndarray
    linked: int  # characters inside links


@lru_cache(maxsize=20_000)
def _element(tag: str, names: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(PATH_DIMS, np.float32)
    for token in (f"<{tag}>", *names):
        out[zlib.crc32(token.encode()) % PATH_DIMS] += 1
    return out


def _tokens(attributes: str) -> tuple[str, ...]:
    if not attributes:
        return ()
    return tuple(sorted({t for m in _NAMES.finditer(attributes) for t in _TOKEN.findall((m[2] or m[3] or m[4] or "").lower())}))


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I)


def _after(page: str, at: int, tag: str, around: list[str], closed: bool) -> int:
    """Where a skipped element that began before ``at`` ends: after its end tag.

    One whose end tag does not come before that of an element around it, or before the next element of its kind, was not
    closed: it ends where the first section, paragraph, list or table after it begins, or else where it should have.
    ``closed``: does the page have an end tag of this kind further on?
    """
    depth, inside, first = 1, [], None
    for m in _MARKUP.finditer(page, at):
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name == tag and (closing or tag in NESTED):
            depth += -1 if closing else not attributes.endswith("/")
            if not depth:
                return m.end()
        elif name == tag or closing and name in around and name not in inside:
            return m.start() if first is None else first
        else:
            if first is None and not closing and name in SECTIONS:
                first = m.start()
                if not closed:
                    return first
            if not closing and name not in VOID and not attributes.endswith("/"):
                inside.append(name)
            elif closing and name in inside:
                inside.remove(name)
    return at if first is None else first


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page that have text, in page order, with references decoded and white space made single.

    A block ends where an element begins or ends that is not inline. A paragraph ends where another block begins,
    closed or not. Comments, declarations and the contents of ``RAW`` and ``SKIPPED`` elements are no text.
    """
    found: list[Block] = []
    zero = np.zeros(PATH_DIMS, np.float32)
    stack: list[tuple[str, np.ndarray, np.ndarray]] = [("", zero, zero)]  # tag, tokens of the path, own tokens
    open_tags: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    last: dict[str, int] = {}  # where the last end tag of a skipped element is

    def flush() -> None:
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                linked = sum(len(p) for p, in_link in parts if in_link)
                block = next(s for s in reversed(stack) if s[0] not in INLINE)
                found.append(Block(text, stack[-1][1], block[2], linked))
            parts.clear()

    def pop() -> None:
        open_tags[stack.pop()[0]] -= 1

    def add(raw: str) -> None:
        parts.append((entities.unescape(raw), open_tags.get("a", 0) > 0))

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not closing:
                close = _end_of(tag).search(page, at)
                at = close.end() if close else end
            parts.append((" ", False))
        elif tag in SKIPPED:
            if not closing and not attributes.endswith("/"):
                if tag not in last:
                    last[tag] = max((m.start() for m in _end_of(tag).finditer(page)), default=-1)
                at = _after(page, at, tag, [t for t, _, _ in stack if t], last[tag] >= at)
            parts.append((" ", False))
        elif tag in VOID:
            if tag == "hr":
                flush()
            parts.append((" ", False))
        elif tag in INLINE:
            if closing:
                if open_tags.get(tag, 0) and stack[-1][0] in INLINE:
                    while stack[-1][0] in INLINE and open_tags.get(tag, 0):
                        done = stack[-1][0] == tag
                        pop()
                        if done:
                            break
            else:
                own = _element(tag, _tokens(attributes))
                stack.append((tag, stack[-1][1] + own, own))
                open_tags[tag] = open_tags.get(tag, 0) + 1
        else:
            flush()
            if closing:
                if open_tags.get(tag, 0):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
            else:
                while stack[-1][0] in INLINE or stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    pop()
                own = _element(tag, _tokens(attributes))
                stack.append((tag, stack[-1][1] + own, own))
                open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return found


@lru_cache(maxsize=200_000)
def _slot(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % WORD_DIMS


def features(found: list[Block]) -> np.ndarray:
    """A row of ``INPUTS`` numbers for each block."""
    out = np.zeros((len(found), INPUTS), np.float32)
    for i, (row, b) in enumerate(zip(out, found, strict=True)):
        row[:PATH_DIMS] = np.minimum(b.path, 2)
        row[PATH_DIMS : 2 * PATH_DIMS] = np.minimum(b.parent, 2)
        words = b.text.split(" ")
        bag = np.bincount([_slot(w) for w in words], minlength=WORD_DIMS)
        row[2 * PATH_DIMS : 2 * PATH_DIMS + WORD_DIMS] = bag / np.sqrt((bag * bag).sum())
        n = len(b.text)
        row[-SIZES:] = (
            np.log1p(n) / 6, np.log1p(len(words)) / 5, min(b.linked / n, 1.0), sum(map(b.text.count, ".,;!?")) / len(words),
            n / len(words) / 10, float(b.text[-1] in ".!?"), i / len(found), 1.0,
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def run_lstm(x: np.ndarray, lengths: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (pages, blocks, HIDDEN) of one direction over padded inputs; behind a page's end states stay zero."""
    pages, longest, _ = x.shape
    gates = x @ w + b
    h = np.zeros((pages, HIDDEN), x.dtype)
    c = np.zeros((pages, HIDDEN), x.dtype)
    out = np.zeros((pages, longest, HIDDEN), x.dtype)
    for t in range(longest):
        live = (t < lengths)[:, None]
        g = gates[:, t] + h @ u
        i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        a = np.tanh(g[:, 3 * HIDDEN :])
        new = f * c + i * a
        if keep is not None:
            keep.append((h, c, i, f, o, a, new))
        c = np.where(live, new, c)
        h = np.where(live, o * np.tanh(new), h)
        out[:, t] = np.where(live, h, 0)
    return out


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's blocks in reverse, padding still behind."""
    place = np.arange(x.shape[1])[None, :]
    back = np.where(place < lengths[:, None], lengths[:, None] - 1 - place, place)
    return np.take_along_axis(x, back[:, :, None], axis=1)


class Labeller:
    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        if weights is None:
            with np.load(WEIGHTS) as stored:
                weights = dict(stored)
        self.p = {k: v.astype(np.float32) for k, v in weights.items()}

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page the chance of each block to be main text."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i, x in enumerate(pages) if len(x)), key=lambda i: len(pages[i]))
        while order:
            # Pages of about one length together; the last is the longest of its pass.
            n = 1
            while n < len(order) and (n + 1) * len(pages[order[n]]) <= PASS_BLOCKS and len(pages[order[n]]) <= 2 * len(pages[order[0]]) + 8:
                n += 1
            chosen, order = order[:n], order[n:]
            lengths = np.array([len(pages[i]) for i in chosen])
            x = np.zeros((n, lengths.max(), INPUTS), np.float32)
            for row, i in enumerate(chosen):
                x[row, : lengths[row]] = pages[i]
            p = self.p
            forward = run_lstm(x, lengths, p["wf"], p["uf"], p["bf"])
            backward = turned(run_lstm(turned(x, lengths), lengths, p["wb"], p["ub"], p["bb"]), lengths)
            z = forward @ p["of"] + backward @ p["ob"] + p["o"]
            for row, i in enumerate(chosen):
                out[i] = _sigmoid(z[row, : lengths[row]])
        return out


@lru_cache(maxsize=1)
def _labeller() -> Labeller:
    return Labeller()


def main_text(pages: list[str], labeller: Labeller | None = None) -> list[str]:
    """The blocks labelled as main text, joined by blank lines; empty if there are none."""
    found = [blocks(p) for p in pages]
    scores = (labeller or _labeller()).scores([features(f) for f in found])
    return ["\n\n".join(b.text for b, s in zip(f, score, strict=True) if s >= 0.5) for f, score in zip(found, scores, strict=True)]


def extract(page: Column) -> Column:
    """The main text of each whole page. A null or empty page, and one without main text, give an empty text.

    Equal pages give equal texts; other columns play no part.
    """

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([t for piece in slices(pages) for t in main_text(as_strings(piece))], pa.string())

    return run(page)
