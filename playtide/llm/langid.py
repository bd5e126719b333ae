"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to ``order`` bytes is counted on a bounded sample and then frozen. A
byte costs -log2 of its share in the longest context the language has seen; where that context never had the byte,
an escape is paid and the next shorter context tried, down to equal shares of all 256 bytes (escape method C). The
language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from playtide.llm.common import as_bytes, give_back, slices

ORDER = 3
#: Bounds of the training sample: documents and bytes of text for each language, bytes of one document, and languages.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, PIECE_BYTES, LANGUAGES = 300, 400_000, 20_000, 64
UNDETERMINED = "und"
#: Codes of over this many bits a byte under every language are like none of them: noise, not prose.
MOST_BITS = 7.0

_LETTER = regex.compile(r"\p{L}")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Numbers, of bytes times languages, that are held at once, and those of them that are looked up at once.
_CHUNK, _BLOCK = 1 << 21, 1 << 18


class _Table:
    """Unsigned integers to rows of numbers, open-addressed, for lookups of whole arrays."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        mask = (1 << self.bits) - 1
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at_row = np.full(1 << self.bits, -1, np.int32)
        self.rows = rows
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):  # the first of those that want a free slot gets it, the others go on
            self.probes += 1
            free = self.at_row[at[left]] < 0
            _, first = np.unique(at[left][free], return_index=True)
            won = left[np.flatnonzero(free)[first]]
            self.keys[at[won]], self.at_row[at[won]] = keys[won], won
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row number of each key, -1 if it has none."""
        at = self._slot(keys)
        row = self.at_row[at]
        other = np.flatnonzero((row >= 0) & (self.keys[at] != keys))
        row[other] = -1
        for _ in range(self.probes - 1):
            if not len(other):
                break
            at[other] = (at[other] + 1) & ((1 << self.bits) - 1)
            found = self.at_row[at[other]]
            same = (found >= 0) & (self.keys[at[other]] == keys[other])
            row[other[same]] = found[same]
            other = other[~same & (found >= 0)]
        return row


@dataclass
class Model:
    """Frozen statistics: for each order the bits of known (context, byte) and the escape bits of known contexts."""

    languages: list[str]
    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]  # by order: keys, bits for each language
    escapes: list[tuple[np.ndarray, np.ndarray]]  # by order: contexts, bits for each language

    def tables(self) -> tuple[list[_Table], list[_Table]]:
        return [_Table(*g) for g in self.grams], [_Table(*e) for e in self.escapes]


def _keys(data: np.ndarray, length: int) -> np.ndarray:
    """For each byte, that byte and the ``length - 1`` before it as one integer; ``order`` bytes of padding come first."""
    out = np.zeros(len(data) - ORDER, np.uint64)
    for back in range(length):
        out |= data[ORDER - back : len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    return out


def _padded(text: bytes) -> np.ndarray:
    return np.frombuffer(b" " * ORDER + text, np.uint8)


def fit(samples: dict[str, list[bytes]]) -> Model:
    """Count the contexts of each language's texts; texts follow ``ORDER`` blanks, so that they start alike."""
    languages = sorted(samples)
    if not languages:
        return Model([], ORDER, [], [])
    counted: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for n, language in enumerate(languages):
        for k in range(ORDER + 1):
            keys = [_keys(_padded(t), k + 1) for t in samples[language] if t]
            counted[n, k] = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.uint64), return_counts=True)
    grams: list[tuple[np.ndarray, np.ndarray]] = []
    escapes: list[tuple[np.ndarray, np.ndarray]] = []
    shape = len(languages)
    for k in range(ORDER + 1):
        all_grams = np.unique(np.concatenate([counted[n, k][0] for n in range(shape)]))
        all_contexts = np.unique(all_grams >> np.uint64(8))
        bits = np.full((len(all_grams), shape), np.nan)
        escape = np.zeros((len(all_contexts), shape))  # nothing is paid where a language has not seen the context
        for n in range(shape):
            keys, counts = counted[n, k]
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            seen = np.bincount(of, counts, len(contexts))
            kinds = np.bincount(of, minlength=len(contexts))
            bits[np.searchsorted(all_grams, keys), n] = -np.log2(counts / (seen + kinds)[of])
            escape[np.searchsorted(all_contexts, contexts), n] = -np.log2(kinds / (seen + kinds))
        # Where another language knows the byte here, the bits of escaping and of the shorter contexts are filled in.
        blank = np.isnan(bits)
        if k:
            low_keys, low_bits = grams[k - 1]
            low = low_bits[np.searchsorted(low_keys, all_grams & np.uint64((1 << 8 * k) - 1))]
        else:
            low = np.full(bits.shape, 8.0)
        fall = escape[np.searchsorted(all_contexts, all_grams >> np.uint64(8))] + low
        bits[blank] = fall[blank]
        grams.append((all_grams, bits))
        escapes.append((all_contexts, escape))
    return Model(languages, ORDER, grams, escapes)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.grams, self.escapes = model.tables()

    def _bits(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte under each language; the first ``ORDER`` bytes are context only."""
        out = np.zeros((len(data) - ORDER, len(self.model.languages)))
        step = max(1 << 12, _BLOCK // len(self.model.languages))
        for at in range(0, len(out), step):
            self._add_bits(data[at : at + step + ORDER], out[at : at + step])
        return out

    def _add_bits(self, data: np.ndarray, out: np.ndarray) -> None:
        left = np.arange(len(out))
        longest = _keys(data, ORDER + 1)
        for k in range(ORDER, -1, -1):
            if not len(left):
                return
            keys = longest[left] & np.uint64((1 << 8 * (k + 1)) - 1)
            row = self.grams[k].find(keys)
            hit = row >= 0
            out[left[hit]] += self.grams[k].rows[row[hit]]
            left, keys = left[~hit], keys[~hit]
            context = self.escapes[k].find(keys >> np.uint64(8))
            known = context >= 0
            out[left[known]] += self.escapes[k].rows[context[known]]
        out[left] += 8.0

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        total = np.zeros((len(texts), len(self.model.languages)))
        if not self.model.languages:
            return total
        pad, step = b" " * ORDER, max(1 << 12, _CHUNK // len(self.model.languages))
        data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
        ends = np.cumsum([ORDER + len(t) for t in texts])
        owner_starts = np.r_[0, ends[:-1]]
        for at in range(0, max(len(data) - ORDER, 0), step):
            piece = data[at : at + step + ORDER]
            if len(piece) <= ORDER:
                break
            bits = self._bits(piece)
            where = np.arange(at + ORDER, at + len(piece))
            owner = np.searchsorted(ends, where, side="right")
            bits[where - owner_starts[owner] < ORDER] = 0  # padding
            cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            total[owner[cuts]] += np.add.reduceat(bits, cuts, axis=0)
        return total

    def predict(self, texts: list[bytes]) -> list[tuple[str, float, float]]:
        """Language, score and bits a byte of each text.

        The score compares the winner's code with the runner-up's on the average byte: 1 - 2 ** -difference, with
        the difference in bits over sixteen bytes. Equal codes score 0, and of equal codes the first language wins.
        """
        lengths = self.code_lengths(texts)
        out = []
        for text, bits in zip(texts, lengths, strict=True):
            if not len(bits) or not text or not _LETTER.search(text.decode("utf-8", "replace")):
                out.append((UNDETERMINED, 0.0, 0.0))
                continue
            best = int(bits.argmin())
            others = np.delete(bits, best)
            gap = 16 * (float(others.min()) - float(bits[best])) / len(text) if len(others) else math.inf
            out.append((self.model.languages[best], 1.0 - 2.0 ** -gap, float(bits[best]) / len(text)))
        return out


def held_out(doc_id: Column) -> Column:
    """One document in five, by crc32 of its id as text; a null id is held out as well."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(
    labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", documents: int = SAMPLE_DOCUMENTS,
    sample_bytes: int = SAMPLE_BYTES, languages: int = LANGUAGES,
) -> Model:
    """A model from the rows that are not held out and have a language.

    For each language the rows of the smallest hash of their id and text are taken: at most ``documents`` of them, of
    each text its first ``PIECE_BYTES`` bytes, as long as they have ``sample_bytes`` together. The ``languages`` with the
    most rows are learnt; labels beyond them are never predicted. A table without labels gives a model without
    languages, under which every text is undetermined.

    The rows are read twice: once for the counts, and once for all languages together, when a limit of the hash that
    follows from the counts leaves about twice the rows wanted. So tasks send few rows, and the driver gets at
    most the sample.
    """
    spark = labelled.sparkSession
    rows = labelled.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & (F.length(F.trim(text)) > 0)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("long"), text).alias("rank"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return fit({})
    span, least = float(1 << 64), -(1 << 63)
    # Of few rows all pass; of many, 2 * documents + 100 on average, so that too few is all but impossible.
    limits = [(r["lang"], int(min((1 << 63) - 1, least + span * min(1.0, (2 * documents + 100) / r["count"])))) for r in counts]
    limited = spark.createDataFrame(limits, "lang string, most bigint")
    by_rank = Window.partitionBy("lang").orderBy("rank", "text")
    found = rows.join(F.broadcast(limited), "lang").where("rank <= most").select("lang", F.left("text", F.lit(PIECE_BYTES)).alias("text"), "rank")
    picked = found.withColumn("place", F.row_number().over(by_rank)).where(F.col("place") <= documents)
    size = F.sum(F.least(F.octet_length("text"), F.lit(PIECE_BYTES))).over(by_rank.rowsBetween(Window.unboundedPreceding, 0))
    samples: dict[str, list[bytes]] = {r["lang"]: [] for r in counts}
    for row in picked.withColumn("size", size).where(F.col("size") <= sample_bytes).select("lang", "text").collect():
        samples[row["lang"]].append(row["text"].encode()[:PIECE_BYTES])
    return fit(samples)


RESULT = "struct<lang_pred:string,score:double,bits_per_byte:double>"


def identify(text: Column, model: Model) -> Column:
    """The language, score and bits a byte of each whole text, as a struct.

    A null, an empty text and one without a letter are ``und`` with score 0, and so is any text under a model that has
    learnt no language. Equal texts give equal results; other
    columns, the language among them, play no part. The model's statistics go along with the task: their size is
    bounded by the training sample. Each text is scored once, also where a filter and a column both use the result:
    Spark repeats a function that it takes for deterministic below a filter, with a Python worker more for each task.
    """

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        scorer = Scorer(model)
        for texts in batches:
            found = [x for piece in slices(texts) for x in scorer.predict(as_bytes(piece))]
            columns = zip(*found, strict=True) if found else ([], [], [])
            kinds = (pa.string(), pa.float64(), pa.float64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.StructArray.from_arrays(arrays, names=["lang_pred", "score", "bits_per_byte"])
        del scorer
        give_back()

    return run.asNondeterministic()(text)


def rejected(result: Column) -> Column:
    """Undetermined texts, and texts that no language codes in under ``MOST_BITS`` bits a byte."""
    return (result["lang_pred"] == UNDETERMINED) | (result["bits_per_byte"] > MOST_BITS)
