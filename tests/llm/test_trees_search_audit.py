"""Tree encoding, ranked search and the filter audit against brute force and the library."""

import base64
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from playtide.llm import best_position, filter_audit, tree_bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# -- tree encoding


@pytest.fixture(scope="module")
def bpe():
    return tree_bpe.TreeBpe(RANKS)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


ODD_TEXTS = ["", " ", "\n\n", "  a  b ", "don't 12345 x1y2", "ﬁ É ß 日本語 🙂 \x00\x1c \x85   x", "<|endoftext|>", "w" * 5000, "ab" * 3000,
             "=" * 4001, " " * 300 + "x", "a\n b\n\nc \n", " a  b", "'s 's", "x" * 7 + "y" * 9]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab c'é日\n\t1.", max_size=60), max_size=4))
def test_tree_encoding_equals_the_library(bpe, library, texts):
    packed = bpe.encode([t.encode() for t in texts])
    for text, ids in zip(texts, packed, strict=True):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_tree_encoding_of_odd_and_long_texts(bpe, library):
    for text in ODD_TEXTS:
        assert np.frombuffer(bpe.encode([text.encode()])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_joins_are_associative_and_equal_merging(bpe):
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("aabcdeé") for _ in range(rng.randint(3, 40))).encode()
        i, j = sorted(rng.sample(range(1, len(text)), 2))
        a, b, c = bpe.merged(text[:i]), bpe.merged(text[i:j]), bpe.merged(text[j:])
        assert bpe.join(bpe.join(a, b), c) == bpe.join(a, bpe.join(b, c)) == bpe._merged(text) == bpe._merged_long(text)
        assert bpe.join(a, ()) == bpe.join((), a) == a


def test_a_match_that_merging_cannot_make_is_its_token(tmp_path):
    names = [bytes([b]) for b in range(256)] + [b"abc", b"bc"]  # a rule for bc comes after abc: merging never makes abc
    names[256], names[257] = b"bcd", b"ab"
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(n) + b" " + str(i).encode() + b"\n" for i, n in enumerate(names)))
    own = tree_bpe.TreeBpe(str(path))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for text in ("bcd", "abcd", "xbcd", "abab bcd"):
        assert np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist() == theirs.encode_ordinary(text)


def test_memos_are_bounded_in_bytes(library):
    small = tree_bpe.TreeBpe(RANKS)
    for memo in (small.windows, small.halves, small.matches, small.words):
        memo.limit = 2000
    rng = random.Random(2)
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcde") for _ in range(8)) for _ in range(40))
        assert np.frombuffer(small.encode([text.encode()])[0], "<u4").tolist() == library.encode_ordinary(text)
        assert small.words.held <= 2000 + 40 * 80


def test_tree_encoding_on_a_table(spark, library):
    rows = [(i, t, "x") for i, t in enumerate([None, *ODD_TEXTS, *ODD_TEXTS[3:5]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    found = rows_of(df.select("doc_id", tree_bpe.round_trip(F.col("text"), RANKS).alias("t")))
    assert len(found) == len(rows)
    for row in found:
        text = rows[row["doc_id"]][1] or ""
        assert row["t"]["ids"] == library.encode_ordinary(text) and bytes(row["t"]["decoded"]) == text.encode()
    again = df.select("doc_id", tree_bpe.encode(F.col("text"), RANKS).alias("ids")).select("doc_id", tree_bpe.decode(F.col("ids"), RANKS).alias("b"))
    assert {r["doc_id"]: bytes(r["b"]) for r in again.collect()} == {i: (t or "").encode() for i, t, _ in rows}
    assert df.limit(0).select(tree_bpe.encode(F.col("text"), RANKS)).count() == 0


# -- ranked search


def slow_top(docs, items, k):
    """Scores of all documents for all items: (item, rank, doc_id, score)."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 10 + (90 * c.total() * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(words(text)) if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i, score))
        out += [(item, r, i, score) for r, (_, _, _, i, score) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def random_docs(rng, n):
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(4000)] + ["É", "naïve", "日本", "X9"]
    return [(i, " ".join(rng.choice(words).upper() if rng.random() < 0.1 else rng.choice(words) for _ in range(rng.choice([1, 5, 60, 200])))) for i in range(n)]


@pytest.mark.parametrize("block_docs", [40, 1 << 14])
def test_search_equals_brute_force(spark, monkeypatch, block_docs):
    rng = random.Random(block_docs)
    docs = random_docs(rng, 300)
    docs += [(None, "w1 w2 w3"), (None, docs[3][1]), (900, None), (901, ""), (902, "?! --"), (7, docs[7][1]), (7, "w1 w1 w1"), (903, "w5 " * 30_000)]
    docs += [(1000 + i, docs[11][1]) for i in range(30)]  # ties beyond the k-th
    items = [(i, t) for i, t in random_docs(rng, 25)] + [(77, None), (78, "..."), (79, "nowhere"), (79, "w1 w1"), (None, "w2 w3")]
    monkeypatch.setattr(best_position, "BLOCK_DOCS", block_docs)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, rank int, score int").repartition(1 if block_docs < 100 else 5)
    queries = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows_of(best_position.top_documents(df, queries, 10))], key=str)
    assert got == slow_top(docs, items, 10)
    parted = best_position.top_documents(df, queries, 10, item_bytes=2000)  # several passes
    assert sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows_of(parted)], key=str) == got


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    docs, terms = 4000, 6
    doc = np.concatenate([rng.permutation(docs) for _ in range(terms)])
    term = np.repeat(np.arange(terms), docs)
    impact = (1e6 / (1 + rng.permutation(docs * terms) / 50)).astype(np.int64) + 1
    block = best_position.Block(doc, term, impact, docs)
    best = best_position.Best(10, np.zeros(0, np.int64), np.zeros(0, np.int64))
    looked_up = best_position.search(block, np.arange(docs), np.arange(terms), best)
    score = np.bincount(doc, weights=impact, minlength=docs).astype(np.int64)
    order = np.lexsort((np.arange(docs), -score))[:10]
    assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == score[order].tolist()
    assert looked_up < docs / 2


def test_search_keeps_ties_of_the_kth(spark):
    """The threshold equals the k-th score here: only a strictly lower one may end the search."""
    docs = [(100 - i, "same words here") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    assert [r["doc_id"] for r in best_position.top_documents(df, items, 5).orderBy("rank").collect()] == [61, 62, 63, 64, 65]


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert best_position.top_documents(docs.limit(0), items).count() == 0
    assert best_position.top_documents(docs, items.limit(0)).count() == 0


# -- filter audit


def slow_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    checked = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 bool(re.search(r"[#$%&*|]", text)), i is not None and i > first[text]]
        checked[lang or ""].append(({c for c, f in zip("ABCDE", fails) if f}, i in good, i in toxic))
    out = {}
    for part, rows in checked.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [r for r in rows if not r[0] & before and letter in r[0]]
                shapley[letter] += len(here)
                out[part, "".join(order), step] = [
                    sum(not r[0] & (before | {letter}) for r in rows), len(here), sum(letter in r[0] and bool(r[0] & before) for r in rows),
                    sum(r[0] == {letter} for r in rows), sum(g for _, g, _ in here), sum(t for _, _, t in here), letter]
        for key, value in out.items():
            if key[0] == part:
                value[-1] = shapley[value[-1]]
    return out


def test_audit_equals_brute_force(spark):
    rng = random.Random(9)
    texts = [None, "", " \t\n", "A b", "x # y", "É " * 250, "one " * 300, " ".join(f"w{k}" for k in range(400)), " ".join(f"W{k}" for k in range(260)),
             " ".join(f"w{k}" for k in range(199)), " ".join(f"w{k}|" for k in range(200)), "z\x1cz\x85z " * 120, " ".join(str(k) for k in range(50_000))]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "en", "de", "x'y"])) for _ in range(400)]
    docs += docs[:20] + [(k, "hot " * 10, "en") for k in range(500, 800)]
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(90)]
    df = spark.createDataFrame([(i, t, p, 1, "m") for i, t, p in docs], "doc_id long, text string, lang string, mask int, part string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = rows_of(filter_audit.audit(df, known))
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
           for r in found}
    assert len(found) == len(got) and got == slow_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).count() == 600
    total = filter_audit.audit(docs, labels).agg(F.sum("removed"), F.sum("good_lost")).first()
    assert (total[0], total[1]) == (120, 120)  # it fails A only


def test_steps_are_all_prefixes(spark):
    rows = rows_of(filter_audit.steps(spark))
    assert len(rows) == 325 * 32 and len({r["prefix"] for r in rows}) == 325
    for r in rows:
        assert r["applied"] == sum(1 << "ABCDE".index(c) for c in r["prefix"][:-1]) and r["bit"] == 1 << "ABCDE".index(r["prefix"][-1])
