"""Token ids of documents in flat binary files.

A folder holds numbered parts. ``part-N.bin`` has the ids of its documents one after the other as unsigned integers
of 16 or 32 bits, ``part-N.idx`` has 64-bit integers: the first id of each document and the end, counted within the
part; then the documents' ids. The parts are in ascending order of document ids, and the manifest has each part's
base: the ids in all parts before it.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from playtide.llm.common import WordMemo, as_bytes, byte_chars, kept_model, laid_out, slices, word_numbers
from playtide.session import work_dir

END = 0
MEMO = 700_000  # words, and pattern matches, that a worker remembers
WRITE_BYTES = 6 << 20  # text that is encoded at once
#: Stands for a null document id in the files.
NO_ID = -(1 << 63)

_CUT = regex.compile(r"(?<=\S) (?=\S)")
#: White space other than blanks and line ends, and the first bytes of such: a text with any is cut by the pattern.
_RARE_ASCII = b"\t\v\f\r\x1c\x1d\x1e\x1f"
_RARE = (b"  ", b" \n", b"\n ", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
#: Pieces of these characters are cut into the pattern's matches here, all others by the library.
_PLAIN = regex.compile(r"[\x20-\x7e\n\u00c0-\u024f]*")


class ByteBpe:
    """Ids of whole texts under a byte-level BPE file, by the tokenizers library.

    The file's pattern never joins a word to the single blank after it, so a text is cut before such blanks and the
    library encodes each different match of the pattern once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merger = self.library.model  # the same rules for matches that are cut already
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.bytes_as_chars = {ord(bytes([b]).decode("latin-1")): c for b, c in byte_chars().items()}
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.matches = WordMemo(self._merge, MEMO)
        self.memo = WordMemo(self._pieces, MEMO)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _merge(self, matches: list[str]) -> list[bytes]:
        """Ids of single matches of the pattern."""
        chars = [m.encode().decode("latin-1").translate(self.bytes_as_chars) for m in matches]
        return [struct.pack(f"<{len(found)}{self.code}", *[t.id for t in found]) for found in map(self.merger.tokenize, chars)]

    def _pieces(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with a blank before it."""
        joined = " ".join(words)
        if not self._plain(joined) or joined.count(" ") >= len(words) or "" in words:
            own = [w != "" and " " not in w and self._plain(w) for w in words]
            plain = iter(self._plain_pieces([w for w, mine in zip(words, own, strict=True) if mine]))
            whole = iter(self._encode([" " + w for w, mine in zip(words, own, strict=True) if not mine]))
            return [next(plain if mine else whole) for mine in own]
        return self._plain_pieces(words)

    def _plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _plain_pieces(self, words: list[str]) -> list[bytes]:
        matches = self.pattern.findall(" " + " ".join(words)) if words else []
        known = self.matches.learn([matches])
        ids = [known[m] for m in matches]
        starts = [k for k, m in enumerate(matches) if m[0] == " "]  # the blank belongs to a word's first match
        ends = [*starts[1:], len(ids)]
        return [ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip(starts, ends, strict=True)]

    def _odd(self, raw: bytes) -> bool:
        """Does the text have white space other than single blanks, and line ends, between words?"""
        return len(raw.translate(None, _RARE_ASCII)) != len(raw) or any(x in raw for x in _RARE) or raw[:1] == b" " or raw[-1:] == b" "

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts with odd white space, which the pattern cuts."""
        split = [_CUT.split(raw.decode()) for raw in texts]
        heads = self._encode([pieces[0] for pieces in split])
        known = self.memo.learn([pieces[1:] for pieces in split])
        return [head + b"".join(map(known.__getitem__, pieces[1:])) for head, pieces in zip(heads, split, strict=True)]

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by ``end`` if given, and how many each has.

        The words of all texts are numbered by their kind and each kind is encoded once; then the ids are laid out by
        these numbers. A text's first word has no blank before it; a text with odd white space is taken as a first word.
        """
        raw = as_bytes(texts)
        odd = [i for i, t in enumerate(raw) if self._odd(t)]
        plain = list(raw)
        for i in odd:
            plain[i] = b""
        lists = pc.split_pattern(pa.array(plain, pa.binary()).cast(pa.string()), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.flatten()
        heads = self._encode(words.take(pa.array(offsets[:-1])).to_pylist())
        for i, ids in zip(odd, self._whole([raw[i] for i in odd]), strict=True):
            heads[i] = ids
        kinds, number = word_numbers(words)
        known = self.memo.learn([[k for k in kinds if k]])
        packed = [known[k] if k else b"" for k in kinds]
        tail = [] if end is None else [np.array([end], self.kind).tobytes()]
        sizes = np.fromiter(map(len, [*packed, *heads, *tail]), np.int64, len(packed) + len(heads) + len(tail)) // self.width
        starts = np.cumsum(sizes) - sizes
        source = np.frombuffer(b"".join([*packed, *heads, *tail]), self.kind)
        which = number.astype(np.int64)
        which[offsets[:-1]] = len(packed) + np.arange(len(raw))
        if end is not None:
            which = np.insert(which, offsets[1:], len(packed) + len(heads))
            offsets = offsets + np.arange(len(offsets))
        size = sizes[which]
        total = np.cumsum(np.r_[0, size])[offsets]
        return laid_out(source, starts[which], size), np.diff(total)


def byte_bpe(path: str) -> ByteBpe:
    return kept_model(("byte_bpe", path), lambda: ByteBpe(path))


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


_PARTS = pa.schema([("part", pa.int32()), ("name", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])


def _write(folder: str, path: str):
    """Sorted rows of a partition to one part. Each attempt has a name of its own; the manifest says which one counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        store, root = _store(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part}-{uuid.uuid4().hex}"
        sizes, doc_ids, out = [], [], None
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), WRITE_BYTES):
                if out is None:
                    store.create_dir(root)
                    out = store.open_output_stream(f"{root}/{name}.bin")
                ids, size = bpe.encode(texts, END)
                out.write(ids.tobytes())
                sizes.append(size)
                doc_ids.append(batch.column("doc_id").slice(at, len(texts)).fill_null(NO_ID).to_numpy())
                at += len(texts)
        if out is None:
            return
        out.close()
        sizes = np.concatenate(sizes)
        offsets = np.cumsum(np.r_[0, sizes]).astype("<i8")
        with store.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(offsets.tobytes())
            index.write(np.concatenate(doc_ids).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(sizes)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
            schema=_PARTS)

    return run


def write(docs: DataFrame, path: str, folder: str | None = None) -> str:
    """Encode all texts, each followed by the id 0, in ascending order of doc_id; the folder written to.

    Null ids come first and null texts are empty. Rows of equal ids are ordered by their text. Other columns are not
    read. The folder has to be one that all executors reach; by default it is in the shared folder of the session.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("__text", F.xxhash64("text"))
    # The last key parts equal rows, of which there may be more than a task should get.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "__text", "__row").sortWithinPartitions("doc_id", "__text", "__row")
    parts = rows.select("doc_id", "text").mapInArrow(_write(folder, path), "part int, name string, documents long, ids long")
    parts.write.parquet(f"{folder}/parts")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """part, name, documents, ids and base of each part; bases are prefix sums over the parts."""
    parts = spark.read.parquet(f"{folder}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    return parts.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class Part:
    """A part's files: mapped into memory where they are local, read by ranges where not."""

    def __init__(self, folder: str, name: str, documents: int, ids: int):
        self.store, self.root = _store(folder)
        self.name, self.documents = name, documents
        index = np.frombuffer(self._open("idx").read_buffer(), "<i8")
        self.offsets, self.doc_ids = index[: documents + 1], index[documents + 1 :]
        self.bin = self._open("bin")
        self.width = self.bin.size() // ids

    def _open(self, kind: str):
        path = f"{self.root}/{self.name}.{kind}"
        local = isinstance(self.store, pafs.LocalFileSystem)
        return pa.memory_map(path) if local else self.store.open_input_file(path)

    def all_ids(self) -> np.ndarray:
        """The ids of all documents of the part."""
        return np.frombuffer(self.bin.read_at(self.bin.size(), 0), f"<u{self.width}")

    def ids(self, document: int) -> np.ndarray:
        """The ids of a document, its end included."""
        start, end = (int(x) * self.width for x in self.offsets[document : document + 2])
        return np.frombuffer(self.bin.read_at(end - start, start), f"<u{self.width}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: ``start`` counts the ids before it."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(folder, row["name"], row["documents"], row["ids"])
                ids, ends = part.all_ids(), part.offsets.tolist()
                crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(part.doc_ids, mask=part.doc_ids == NO_ID), pa.array(row["base"] + part.offsets[:-1]),
                    pa.array(np.diff(part.offsets)), pa.array(crc, pa.int64())], schema=schema)

    parts = manifest(spark, folder).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "name")
    return parts.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
