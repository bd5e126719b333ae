"""Quality rules from what a public tokenizer makes of a text.

Prose of a language the vocabulary was learnt from takes few tokens a word, no byte fallback and many different
tokens. Each language has bands for characters per token, the share of byte-fallback tokens and the entropy of the
tokens, which grows with their number; a text outside its bands is rejected. A text without a language, or of one that
has no bands, has those of its script.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, functions as F

from playtide.llm.common import WordMemo, as_bytes, kept_model, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50


@dataclass(frozen=True)
class Band:
    """What a text may have: characters per token, share of byte-fallback tokens, bits of entropy of its tokens."""

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float
    entropy_by_size: tuple[tuple[int, float], ...] = ()  # (tokens, least entropy of texts with as many or more), ascending

    def entropy_floor(self, tokens: int) -> float:
        return max([self.least_entropy, *[e for n, e in self.entropy_by_size if n <= tokens][-1:]])


#: Bands of languages, before those of scripts: the lower quartile less twice the distance of the quartiles; entropy by
#: powers of two of the token count. Measured over the documents of sf0.1 that pass the base rule and whose id has a
#: crc32 that is not 0 modulo 5 (7159, of which 7.9 % fall outside). Of the other 1725, which played no part, 9.0 % do.
#: Documents of less than 128 tokens are too few to measure. Nothing is cut above: more characters a token are nearer
#: to the vocabulary. Other corpora, and other languages, need bands of their own.
LANGUAGES = {
    "en": Band(2.09, 7.0, 0.10, 3.5, ((128, 5.48), (256, 5.93), (512, 6.29), (1024, 6.54), (2048, 6.72), (4096, 6.73))),
    "de": Band(2.11, 7.0, 0.10, 3.5, ((128, 5.47), (256, 5.91), (512, 6.15), (1024, 6.32), (2048, 6.54), (4096, 6.59))),
    "es": Band(1.81, 7.0, 0.10, 3.5, ((128, 5.32), (256, 5.74), (512, 6.11), (1024, 6.45), (2048, 6.54), (4096, 6.68))),
    "fr": Band(1.85, 7.0, 0.10, 3.5, ((128, 5.36), (256, 5.83), (512, 6.10), (1024, 6.33), (2048, 6.43), (4096, 6.49))),
}


def loosest(bands: list[Band]) -> Band:
    """What any of the bands lets through; entropy by the sizes that the first of them names."""
    by_size = tuple((n, min(b.entropy_floor(n) for b in bands)) for n, _ in bands[0].entropy_by_size)
    return Band(min(b.least_chars for b in bands), max(b.most_chars for b in bands), max(b.most_fallback for b in bands),
                min(b.least_entropy for b in bands), by_size)


#: Bands of scripts. A Latin text without a language of its own has to pass as any of those measured. The vocabulary is
#: mostly Latin, so other scripts take about a token a character and some take bytes; their bands are not measured.
BANDS = {
    "latin": loosest(list(LANGUAGES.values())),
    "cyrillic": Band(1.0, 6.0, 0.10, 3.5),
    "greek": Band(0.7, 4.0, 0.30, 3.0),
    "cjk": Band(0.3, 2.5, 0.70, 3.5),
    "other": Band(0.25, 5.0, 0.95, 2.5),
}

#: Code points of scripts, as ranges with exclusive ends; letters elsewhere are "other".
SCRIPTS = (
    ("latin", ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0x1E00, 0x1F00))),
    ("greek", ((0x370, 0x400), (0x1F00, 0x2000))),
    ("cyrillic", ((0x400, 0x530),)),
    ("other", ((0x530, 0x1E00), (0xA000, 0xAC00))),
    ("cjk", ((0x3040, 0xA000), (0xAC00, 0xD7B0), (0xF900, 0xFB00), (0x20000, 0x32000))),
)


def script_of(text: str) -> str:
    """The script of most letters; of equal ones the first in ``SCRIPTS``, "other" without letters."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    best, most = "other", 0
    for name, ranges in SCRIPTS:
        n = sum(int(((points >= a) & (points < b)).sum()) for a, b in ranges)
        if n > most:
            best, most = name, n
    return best


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice, the first occurrence included."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1_000_000:  # three numbers would not fit into 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
        width = len(words)
    else:
        width = len(number)
    windows = pairs[:-1] * width + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = order[np.r_[same, False] | np.r_[False, same]]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[twice + k] = True
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


class Pieces:
    """Token ids of words under a SentencePiece model, each word by itself with its leading blank."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.memo = WordMemo(self._encode)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        found = self.model.encode([w.decode() for w in words], num_threads=1)
        return [np.array(ids, "<u4").tobytes() for ids in found]

    def ids(self, split: list[list[bytes]]) -> list[np.ndarray]:
        known = self.memo.learn(split)
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4") for words in split]


def _pieces(path: str) -> Pieces:
    return kept_model(("pieces", path), lambda: Pieces(path))


def entropy(ids: np.ndarray) -> float:
    if not len(ids):
        return 0.0
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(counts * np.log2(counts)).sum()) + 0.0


RESULT = (
    "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,"
    "kept:boolean,script:string,chars_per_token:double,fallback_share:double,token_entropy:double>"
)
_KIND = pa.struct([
    *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("script", pa.string()),
    *((c, pa.float64()) for c in ("chars_per_token", "fallback_share", "token_entropy")),
])


def measure(
    texts: list[bytes], path: str, bands: dict[str, Band] = BANDS, langs: list[str | None] | None = None,
    languages: dict[str, Band] = LANGUAGES,
) -> list[dict]:
    model = _pieces(path)
    split = [t.split() for t in texts]  # bytes part at ASCII white space only
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    blank = np.zeros(256, bool)
    blank[list(b" \t\n\v\f\r")] = True
    out = []
    for text, words, ids, lang in zip(texts, split, model.ids(split), langs or [None] * len(texts), strict=True):
        raw = np.frombuffer(text, np.uint8)
        chars = int(((raw & 0xC0) != 0x80).sum() - blank[raw].sum())
        repeats = repeated_words(words)
        failed = len(words) < MIN_WORDS or 100 * repeats > MOST_REPEATED_PERCENT * len(words)
        script = script_of(text.decode())
        per_token = chars / len(ids) if len(ids) else 0.0
        fallback = float(model.is_byte[ids].mean()) if len(ids) else 0.0
        bits = entropy(ids)
        band = languages.get(lang, bands[script])
        inside = band.least_chars <= per_token <= band.most_chars and fallback <= band.most_fallback and bits >= band.entropy_floor(len(ids))
        out.append({
            "n_words": len(words), "word_chars": chars, "n_symbols": int(symbol[raw].sum()),
            "n_dup_lines": duplicate_lines(text), "n_repeat_words": repeats, "base_failed": failed,
            "kept": bool(not failed and inside), "script": script,
            "chars_per_token": per_token, "fallback_share": fallback, "token_entropy": bits,
        })
    return out


def quality(
    text: Column, path: str, bands: dict[str, Band] = BANDS, lang: Column | None = None, languages: dict[str, Band] = LANGUAGES,
) -> Column:
    """Counts, tokenizer measures and the verdict of each whole text, as a struct.

    A null or blank text has no words, fails the base rule and measures 0. ``lang`` is the language a text is held
    against; where it is null, not given or not in ``languages``, the script decides. Ties between scripts go to the
    first of ``SCRIPTS``. Equal texts of one language give equal results; other columns play no part.
    """

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, langs in batches:
            rows, at = [], 0
            for piece in slices(texts):
                rows += measure(as_bytes(piece), path, bands, langs.slice(at, len(piece)).to_pylist(), languages)
                at += len(piece)
            yield pa.array(rows, _KIND)

    return run(text, F.lit(None).cast("string") if lang is None else lang)
