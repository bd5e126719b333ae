"""Exact Jaccard join of word shingles with adaptive multi-match prefixes.

Sort every set's shingles in one global order, rare ones first. If two sets of sizes a and b share at least o
shingles, the first a - o + l of one and the first b - o + l of the other share at least l of them. A longer prefix
thus asks for more shared shingles before a pair is verified, and each set gets the l that its postings make
cheapest. Three exact steps keep the work in proportion to the input:

1. Equal sets are one. A set can only link if at most a quarter of its shingles occur in no other set, so sets with
   more are out. Shingles are looked at in one fixed part of the hash space, the same for all documents.
2. The prefixes of the sets that are left are joined with the leader of each posting list only; verified links make
   components. This is linear even where thousands of near copies share all their shingles.
3. Posting lists that still hold several components are joined in full, across components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide.llm.common import WordMemo, as_bytes, give_back, hash_filter, may_have, mixed, slices
from playtide.operators.skew import ROWS_PER_TASK, hot_counted, split_hot_join
from playtide.session import work_dir

WIDTH = 5
PERCENT = 75
#: Share of the hash space in which step 1 looks for shingles without a partner.
PROBED = 0.4
#: Text of a task that is worked on together in step 1; what repeats inside it is sent once.
SCAN_BYTES = 4 << 20
MOST_MATCHES = 8
LEADER_ROUNDS = 3
SIGNATURE_LONGS = 32
#: Bits of the filter that spares texts of documents which cannot link; larger inputs only make it less sharp.
FILTER_BITS = (20, 26)

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = np.int64(-1)


def required(n: np.ndarray | int, percent: int = PERCENT):
    """Shingles that a set of n must share with one that is not smaller than percent % of it and not larger."""
    return -(-n * percent // 100)


class Shingles:
    """The distinct shingles of texts as sorted unsigned 64-bit hashes."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.memo = WordMemo(lambda words: [xxhash.xxh64_intdigest(w) for w in words])

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.lower().split() for t in texts]  # bytes: only A-Z change, only ASCII white space parts words
        known = self.memo.learn(split)
        out = []
        for words in split:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            if len(h) >= self.width:
                key = h[: len(h) - self.width + 1].copy()
                for k in range(1, self.width):
                    key = key * _FACTOR + h[k : len(h) - self.width + 1 + k]
                out.append(np.unique(mixed(key)))
            elif len(h):
                key = np.uint64(len(h))
                with np.errstate(over="ignore"):
                    for x in h:
                        key = key * _FACTOR + x
                out.append(mixed(np.array([key ^ _FACTOR], np.uint64)))
            else:
                out.append(h)
        return out


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else b""


_SCAN = "bucket int, tokens binary, owners binary, doc_ids binary, no_ids binary, texts binary, sets binary, sizes binary"
_SCAN_ARROW = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in (
    "tokens", "owners", "doc_ids", "no_ids", "texts", "sets", "sizes"))])
_FACTS = "doc_id long, text_hash long, set_id binary, size int, probed int, owner long, met int"
_FACTS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_id", pa.binary()),
                          ("size", pa.int32()), ("probed", pa.int32()), ("owner", pa.int64()), ("met", pa.int32())])


def _owner(digest: bytes) -> int:
    """A non-negative number for a set; two sets that share one only look better connected than they are."""
    return int.from_bytes(digest[:8], "little") >> 1


def _scan(buckets: int, width: int):
    """Text rows to rows for ``buckets`` posting buckets, and one row with the documents themselves."""
    limit = np.uint64(int(PROBED * (1 << 64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), SCAN_BYTES):
                rows = batch.slice(at, len(texts))
                at += len(texts)
                sets = shingles.sets(as_bytes(texts))
                digests = [_digest(s) for s in sets]
                own = {d: s for d, s in zip(digests, sets, strict=True) if d}
                owners = np.fromiter(map(_owner, own), np.int64, len(own))
                probed = [s[: np.searchsorted(s, limit)] for s in own.values()]
                tokens = np.concatenate(probed) if probed else np.zeros(0, np.uint64)
                of = np.repeat(owners, [len(p) for p in probed])
                order = np.argsort(tokens, kind="stable")
                tokens, of = tokens[order], of[order]
                new = np.r_[True, tokens[1:] != tokens[:-1]] if len(tokens) else np.zeros(0, bool)
                runs = np.flatnonzero(new)
                several = np.diff(np.r_[runs, len(tokens)]) > 1
                # Shingles of several sets of this slice: their owners are credited here, one entry goes on.
                local = np.repeat(several, np.diff(np.r_[runs, len(tokens)]))
                who, met = np.unique(of[local], return_counts=True)
                tokens, of = tokens[runs], np.where(several, _REPEATED, of[runs])
                bucket = (tokens % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                tokens = (tokens // np.uint64(buckets)).astype("<u4")[order]
                of, bucket = of[order], bucket[order]
                starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
                stops = [*starts[1:].tolist(), len(bucket)]
                ids = rows.column("doc_id").cast(pa.int64())
                first = int(xxhash.xxh32_intdigest(digests[0] + len(texts).to_bytes(4, "little")))
                yield pa.RecordBatch.from_arrays([
                    pa.array([*bucket[starts].tolist(), buckets + first % buckets, buckets + (first + 1) % buckets], pa.int32()),
                    pa.array([*(tokens[a:b].tobytes() for a, b in zip(starts, stops)), None, None], pa.binary()),
                    pa.array([*(of[a:b].tobytes() for a, b in zip(starts, stops)), None, who.tobytes()], pa.binary()),
                    *(pa.array([None] * len(starts) + x, pa.binary()) for x in (
                        [pc.fill_null(ids, 0).to_numpy().tobytes(), None],
                        [ids.is_null().to_numpy(zero_copy_only=False).tobytes(), None],
                        [rows.column("text_hash").to_numpy().tobytes(), None],
                        [b"".join(d.ljust(16, b"\0") for d in digests), None],
                        [
                            np.array([(len(s), np.searchsorted(s, limit)) for s in sets], np.int32).tobytes(),
                            met.astype(np.int32).tobytes(),
                        ],
                    )),
                ], schema=_SCAN_ARROW)
        del shingles  # an idle worker holds no words
        give_back()

    return run


def _gather(table: pa.Table) -> pa.Table:
    """One bucket: which owners' shingles met another set; or the rows of documents as they came."""
    cells = {c: table.column(c).to_pylist() for c in table.column_names}
    out = []

    def credits(owners: np.ndarray, met: np.ndarray) -> None:
        none = lambda kind: pa.nulls(len(owners), kind)
        out.append(pa.table([none(pa.int64()), none(pa.int64()), none(pa.binary()), none(pa.int32()), none(pa.int32()),
                             pa.array(owners, pa.int64()), pa.array(met.astype(np.int32))], schema=_FACTS_ARROW))

    parts = [i for i, t in enumerate(cells["tokens"]) if t is not None]
    if parts:
        tokens = np.concatenate([np.frombuffer(cells["tokens"][i], "<u4") for i in parts])
        owners = np.concatenate([np.frombuffer(cells["owners"][i], np.int64) for i in parts])
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        runs = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        lengths = np.diff(np.r_[runs, len(tokens)])
        # Entries of one set that came from two slices are copies of it: they count as met, which loses nothing.
        hit = owners[np.repeat(lengths > 1, lengths)]
        credits(*np.unique(hit[hit != _REPEATED], return_counts=True))
    for i, t in enumerate(cells["tokens"]):
        if t is None and cells["doc_ids"][i] is None:
            credits(np.frombuffer(cells["owners"][i], np.int64), np.frombuffer(cells["sizes"][i], np.int32))
        elif t is None:
            raw = cells["sets"][i]
            sizes, probed = np.frombuffer(cells["sizes"][i], np.int32).reshape(-1, 2).T.copy()
            sets = [raw[k : k + 16] if n else None for k, n in zip(range(0, len(raw), 16), sizes.tolist(), strict=True)]
            out.append(pa.table([
                pa.array(np.frombuffer(cells["doc_ids"][i], np.int64), mask=np.frombuffer(cells["no_ids"][i], bool)),
                pa.array(np.frombuffer(cells["texts"][i], np.int64)),
                pa.array(sets, pa.binary()), pa.array(sizes), pa.array(probed),
                pa.array([None if s is None else _owner(s) for s in sets], pa.int64()),
                pa.nulls(len(sizes), pa.int32()),
            ], schema=_FACTS_ARROW))
    return pa.concat_tables(out)


#: Rows of small frames, of pairs and links, that a task writes.
PAIRS_OF_TASK = 100_000
#: Rows of one shingle, or links of one set, that a task of a join gets; those of larger ones are spread.
HOT_ROWS = ROWS_PER_TASK


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Written once to the shared folder and read back: lineage ends here, and a lost executor costs its tasks only.

    ``rows``: how many there may be, of pairs of numbers; few of them go to few files.
    """
    path = work_dir(df.sparkSession, label)
    if rows is not None:
        df = df.coalesce(1 + rows // PAIRS_OF_TASK)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _buckets(spark: SparkSession) -> int:
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _tokenised(bitmap, width: int):
    """Texts that the filter lets through, as sorted shingles."""
    schema = pa.schema([("set_id", pa.binary()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bitmap.value
        shingles = Shingles(width)
        for batch in batches:
            keep = may_have(words, batch.column("text_hash").to_numpy())
            for texts in slices(batch.column("text").filter(pa.array(keep))):
                sets = {_digest(s): s.view(np.int64) for s in shingles.sets(as_bytes(texts)) if len(s)}
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.binary()), _lists(list(sets.values()))], schema=schema)
        del shingles
        give_back()

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


_PARTS = tuple(f"signature_{k}" for k in range(SIGNATURE_LONGS))


def _signature(tokens: F.Column) -> F.Column:
    """One bit for each shingle of a set, by its hash, in a fixed number of 64-bit integers."""

    @F.arrow_udf(", ".join(f"{c} long" for c in _PARTS))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            out = np.zeros((len(lists), SIGNATURE_LONGS), np.uint64)
            flat = lists.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            part = (flat >> np.uint64(6)) % np.uint64(SIGNATURE_LONGS)
            np.bitwise_or.at(out, (row, part.astype(np.int64)), np.uint64(1) << (flat & np.uint64(63)))
            yield pa.StructArray.from_arrays([pa.array(c.copy()) for c in out.view(np.int64).T], names=list(_PARTS))

    return run(tokens)


def matches_wanted(counts: np.ndarray, size: int, percent: int = PERCENT) -> int:
    """The l that makes a set's prefix cheapest. ``counts``: in ascending order, the number of sets that have each of
    its shingles, for those that are in others too.

    A prefix costs the postings it reads. Each candidate it yields costs a verification of the set's size, and
    since a candidate has to turn up l times, there are at most a l-th as many as postings.
    """
    base = size - required(size, percent) - (size - len(counts))  # shingles of no other set come first and cost nothing
    read = np.cumsum(counts - 1, dtype=np.float64)
    ells = np.arange(1, min(MOST_MATCHES, len(counts) - base) + 1)
    postings = read[base + ells - 1]
    return int(ells[np.argmin(postings + postings / ells * size)])


def _postings(percent: int):
    schema = pa.schema([("token", pa.int64()), ("sid", pa.int64()), ("size", pa.int32()),
                        ("matches", pa.int32()), ("early", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in schema]
            ids, sizes = batch.column("sid").to_pylist(), batch.column("size").to_pylist()
            for sid, n, shared in zip(ids, sizes, batch.column("shared"), strict=True):
                counts, tokens = (shared.values.field(c).to_numpy() for c in ("count", "token"))
                alone = n - len(tokens)
                ell = matches_wanted(counts, n, percent)
                long = n - required(n, percent) + ell - alone
                short = n - int(-(-2 * percent * n // (100 + percent))) + ell - alone
                for column, x in zip(out, (
                    tokens[:long], np.full(long, sid), np.full(long, n, np.int32),
                    np.full(long, ell, np.int32), np.arange(long) < short), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), k.type) if c else pa.array([], k.type) for c, k in zip(out, schema)], schema=schema)

    return run


def _with(rows: DataFrame, totals: DataFrame, key: str, n: str, most: int | None = None, how: str = "inner") -> DataFrame:
    """The rows beside their key's totals, of which ``n`` counts the key's rows.

    Spark splits no skewed side next to an aggregate, so large keys are spread by their counts. ``most``: how many rows
    there are, where that is known; few need no look at the counts.
    """
    if most is not None and most <= HOT_ROWS:
        return rows.join(totals, key, how)
    totals = staged(totals, "totals")
    hot = hot_counted(totals, [key], n, HOT_ROWS)
    return split_hot_join(rows, totals, [key], how, hot=hot)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component): the smallest node each node of the edges (a, b) can reach.

    Rounds of two steps until nothing changes: every neighbour larger than a node moves to the node's smallest
    neighbour, then every smaller one does. Each step is a minimum by node and a join; paths halve in each round. A node
    with more links than a task should get is counted with its minimum, and its links are spread over several tasks.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", rows)
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen, rows = mark, mark[0]
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count("*").alias("n"))
        large = _with(both.where("b > a"), low, "a", "n", 2 * rows).select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = _with(large, low, "a", "n", 2 * rows)
        edges = staged(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "edges", rows)


@dataclass
class Linked:
    """``documents``: doc_id, text_hash, set_id, size of each input row; ``sets``: set_id, component, for linked sets."""

    documents: DataFrame
    sets: DataFrame


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> Linked:
    """Find the groups of documents linked by a Jaccard similarity of at least ``percent`` %.

    A null or blank text has no shingles and links with nothing. Texts with fewer than ``width`` words are one
    shingle. Documents with equal sets are linked; repeated rows and ids are kept apart by their text. Null ids are
    allowed. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"))
    scanned = rows.mapInArrow(_scan(_buckets(spark), width), _SCAN)
    facts = staged(scanned.groupBy("bucket").applyInArrow(_gather, _FACTS), "shingle-facts")
    documents = facts.where("text_hash is not null").drop("met")
    met = facts.where("met is not null").groupBy("owner").agg(F.sum("met").alias("met"))
    sets = documents.where("size > 0").groupBy("set_id").agg(
        *(F.first(c).alias(c) for c in ("owner", "size", "probed")), F.min("text_hash").alias("text_hash"))
    alone = F.col("probed") - F.coalesce("met", F.lit(0))  # at least so many shingles are in no other set
    able = staged(sets.join(met, "owner", "left").where(
        alone <= F.col("size") - F.ceil(F.col("size") * percent / 100)).select("set_id", "text_hash"), "shingle-sets")
    bitmap = spark.sparkContext.broadcast(hash_filter(able, "text_hash", *FILTER_BITS))
    read = rows.select("text", "text_hash").mapInArrow(_tokenised(bitmap, width), "set_id binary, tokens array<long>")
    kept = read.join(able.select("set_id"), "set_id").dropDuplicates(["set_id"])
    read = staged(kept.select(F.monotonically_increasing_id().alias("sid"), "set_id", "tokens"), "shingle-sets")
    each = read.select("sid", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count("*").alias("count")).where("count > 1")  # few next to all shingles
    # A set's shingles that are in others too, rare ones first; sets with too few of them cannot link.
    shared = _with(each, counts, "token", "count").groupBy("sid", "size").agg(
        F.sort_array(F.collect_list(F.struct("count", "token"))).alias("shared")
    ).where(F.size("shared") >= F.ceil(F.col("size") * percent / 100))
    postings = staged(shared.mapInArrow(
        _postings(percent), "token long, sid long, size int, matches int, early boolean"), "postings")
    kept = read.join(postings.select("sid").distinct(), "sid", "left_semi")
    sets = staged(kept.select("*", _signature(F.col("tokens")).alias("signature")).select("*", "signature.*"), "shingle-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar enough, by their whole sets."""
        of = lambda side: sets.select(F.col("sid").alias(side), F.col("tokens").alias(f"{side}_tokens"))
        both = pairs.join(of("a"), "a").join(of("b"), "b")
        shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
        total = F.size("a_tokens") + F.size("b_tokens")
        # 100 * shared >= percent * (total - shared)
        return both.where((100 + percent) * shared >= percent * total).select("a", "b")

    def alike(x: str, y: str) -> F.Column:
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    links, labels, total = None, None, postings.count()
    for turn in range(LEADER_ROUNDS + 1):
        placed = postings.withColumn("component", F.col("sid")) if labels is None else postings.join(
            labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
        lists = placed.groupBy("token").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            # The first leaders are few, as sets rank alike in all lists; later ones differ from list to list.
            F.min(F.struct((F.xxhash64("sid", "token", F.lit(turn)) if turn else F.xxhash64("sid")).alias("rank"), F.col("sid").alias("leader"),
                           F.col("size").alias("leader_size"), F.col("component").alias("leader_component"))).alias("first"),
            F.count("*").alias("places"),
        ).where("low <> high")
        if turn < LEADER_ROUNDS:
            pairs = _with(placed, lists.select("token", "places", "first.*"), "token", "places", total).where(
                (F.col("component") != F.col("leader_component")) & alike("size", "leader_size")
            ).select(F.least("sid", "leader").alias("a"), F.greatest("sid", "leader").alias("b")).distinct()
        else:
            several = _with(placed, lists.select("token", "places"), "token", "places", total, "left_semi")
            several = several.join(sets.select("sid", *_PARTS), "sid")
            columns = ("sid", "size", "matches", "component", *_PARTS)
            left = several.where("early").select("token", *(F.col(c).alias(f"x_{c}") for c in columns))
            right = several.select("token", *(F.col(c).alias(f"y_{c}") for c in columns))
            # Sets differ in as many shingles as their signatures do in bits, or more.
            apart = sum((F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in _PARTS), F.lit(0))
            sizes = F.col("x_size") + F.col("y_size")
            pairs = left.join(right, "token").where(
                F.expr("x_component <> y_component and (x_size < y_size or x_size = y_size and x_sid < y_sid)")
                & alike("x_size", "y_size") & ((100 + percent) * (sizes - apart) >= 2 * percent * sizes)
            ).groupBy(F.col("x_sid").alias("a"), F.col("y_sid").alias("b")).agg(
                F.count("*").alias("met"), F.first(F.least("x_matches", "y_matches")).alias("matches")
            ).where("met >= matches").select("a", "b")
        pairs = staged(pairs, "pairs")
        found = staged(verified(pairs), "links", pairs.count())
        links = found if links is None else links.unionByName(found)
        labels = components(links, links.count())
    return Linked(
        documents.drop("owner", "probed"),
        sets.select("sid", "set_id").join(labels.withColumnRenamed("node", "sid"), "sid").select("set_id", "component"),
    )


def groups(linked: Linked) -> DataFrame:
    """doc_id, n_shingles, component_id (and text_hash, set_id) for each input row.

    The component of a document is the smallest doc_id of the documents linked with it. A document without shingles
    is its own. Null ids are not the smallest of anything: where all are null, so is the component.
    """
    of_set = linked.documents.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    grouped = of_set.join(linked.sets, "set_id")
    least = grouped.groupBy("component").agg(F.min("least").alias("linked_least"))
    named = of_set.join(
        grouped.join(least, "component").select("set_id", "linked_least"), "set_id", "left"
    ).select("set_id", F.coalesce("linked_least", "least").alias("component_id"))
    return linked.documents.join(named, "set_id", "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash", "set_id",
    )


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with one of each group left: the one of the smallest id, of equal ids the one whose text has the
    smallest hash, of equal rows any one. Documents without shingles all stay. All columns are kept."""
    found = staged(groups(link(docs, text, doc_id)), "groups")
    linked = found.where("set_id is not null")
    # Documents of a set whose ids are all null have no id to group by; their set stands for them.
    group = F.coalesce(F.col("component_id").cast("string"), F.hex("set_id"))
    order = F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "text_hash")
    first = linked.groupBy(group.alias("group")).agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    copies = linked.groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies"))
    first = first.alias("f").join(copies.alias("c"), F.expr("f.doc_id <=> c.doc_id and f.text_hash = c.text_hash")).select(
        "f.doc_id", "f.text_hash", "copies")
    blank = found.where("set_id is null").select("doc_id", "text_hash", F.lit(1).alias("copies")).distinct()
    keys = first.unionByName(blank).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "copies")
    kept = docs.withColumn("__text", F.xxhash64(text)).join(
        keys, (F.col("__text") == F.col("__hash")) & F.col(doc_id).cast("long").eqNullSafe(F.col("__id")))
    once = kept.where("copies = 1")
    repeated = kept.where("copies > 1").dropDuplicates(["__id", "__hash"])
    return once.unionByName(repeated).select(*docs.columns)
