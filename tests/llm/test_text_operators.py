"""Each operator against brute force on small tables with nulls, empty, long and repeated texts and extra columns."""

import hashlib
import math
import random
import re
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playtide.llm import (
    chat, decontaminate, fertility, html_blocks, langid, line_dedup, ngram_join, secret_scan, token_files, train_blocks, word_bpe,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, start string"  # `start` clashes with a result column


def prose(rng, n, words="the of and to river stone light maker under north glass seven paper".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "ly", "ing", "s"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    odd = [None, "", "   ", "\n\n", "one", "a b c d", "ﬁ É ß 日本語 🙂 \x00\x1c \x85", "<|endoftext|> x <|startoftext|>", "a  b\n c \t d",
           "w" * 5000, "DON'T can't 12345 x1y2"]
    return odd + [prose(rng, rng.choice([3, 40, 400])) for _ in range(40)] + [prose(rng, 20_000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "x") for i, t in enumerate(texts)] + [(None, "one more", None, None), (3, "again", "en", "x"), (3, "again", "en", "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- secrets


def slow_windows(run, window, bits):
    hit = set()
    for i in range(len(run) - window + 1):
        part = run[i : i + window]
        h = -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part))
        if h >= bits - 1e-9:
            hit.update(range(i, i + window))
    return hit


def test_entropy_windows_by_incremental_counts():
    rng = random.Random(1)
    for _ in range(60):
        run = "".join(rng.choice("abcdef0123456789"[: rng.choice([2, 6, 16])]) for _ in range(rng.randint(0, 80)))
        got = {i for a, b in secret_scan.entropy_windows(run, 16, 3.1) for i in range(a, b)}
        assert got == slow_windows(run, 16, 3.1)


def test_secrets(spark, docs):
    key = "aZ3kQ9xLm2Pv7Rt5Yw8Bn4Cd6Ef1Gh0"
    rows = [(1, f"é password = 'hunter22' AKIA{'A1' * 8} {'0f' * 12} x"), (2, f"use {key} now"), (3, "secret=token:abcdefgh ſecret=abcdefgh"),
            (4, "123e4567-e89b-12d3-a456-426614174000 abcdefghijklmnopqrstuvwxyz0123456789"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], rows[r["doc_id"] - 1][1][s["start"] : s["end"]]) for s in r["s"]]
             for r in rows_of(df.select("doc_id", secret_scan.secrets(F.col("text")).alias("s")))}
    assert found[1] == [("assign", "password = 'hunter22"), ("access", "AKIA" + "A1" * 8), ("hex", "0f" * 12)]
    assert found[2] == [("entropy", key)]
    assert found[3] == [] and found[4] == [] and found[5] == []
    masked = {r["doc_id"]: r["t"] for r in rows_of(df.select("doc_id", secret_scan.redact(F.col("text")).alias("t")))}
    assert masked[2] == "use [SECRET] now" and masked[5] is None and masked[3] == rows[2][1]
    allowed = df.where("doc_id = 2").select(secret_scan.secrets(F.col("text"), allowed_texts=frozenset({key})).alias("s"))
    assert allowed.first()["s"] == []
    assert docs.select(secret_scan.secrets(F.col("text"))).count() == docs.count()
    assert empty(spark).select(secret_scan.secrets(F.col("text"))).count() == 0


# -- chat


def test_chat_layouts_and_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|user|>\nx</s>\n", "<\\|a|>|\\>", "\\", "<<SYS>>\n<|>", None, "", "|", "<"]
    turns = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", None, "a|", "|>"] * 2, tricky))]
    turns.append(turns[0])  # a repeated row is a repeated turn
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    back = rows_of(chat.parsed(chat.formatted(df, "conv_id", ["turn"]), "conv_id"))
    for row in back:
        mine = sorted([(t, r or "", x or "") for c, t, r, x in turns if c == row["conv_id"]])
        assert [(t["role"], t["text"]) for t in row["turns"]] == [(r, x) for _, r, x in mine]
        assert row["loss"] == "".join(x for _, r, x in mine if r == "assistant")
        assert row["formatted"].count("</s>\n") == len(mine)
        for span in row["loss_spans"]:
            assert span["turn_start"] <= span["start"] <= span["end"] <= len(row["formatted"])
    records = spark.read.json(spark.sparkContext.parallelize([
        '{"id":1,"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}',
        '{"id":2,"instruction":"do","input":"this","output":"done"}', '{"id":3,"prompt":"p","response":"r","system":"s"}',
        '{"id":4,"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', '{"id":5,"other":1}', '{"id":6,"prompt":"p","completion":"c"}']))
    found = {r["id"]: (r["layout"], r["turns"] and [(t["role"], t["text"]) for t in r["turns"]]) for r in rows_of(chat.canonical(records, ("id",)))}
    assert found[1] == ("messages", [("user", "a"), ("assistant", "b")])
    assert found[2] == ("instruction", [("user", "do\n\nthis"), ("assistant", "done")])
    assert found[3] == ("prompt", [("system", "s"), ("user", "p"), ("assistant", "r")])
    assert found[4] == ("conversations", [("user", "h"), ("assistant", "g")])
    assert found[6] == ("completion", [("user", "p"), ("assistant", "c")])


# -- repeated lines


def test_repeated_units(spark, docs):
    unit = "This sentence of many words stands in several documents here."
    rows = [(2, f"Intro of it. {unit} Then more."), (1, f"{unit.upper()}\nsecond"), (None, unit), (4, None), (5, "short. short."), (2, f"Intro of it. {unit} Then more.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["start"], r["end"], r["kept_doc_id"]) for r in rows_of(line_dedup.repeated(df))}
    assert got == {(2, 13, 13 + len(unit), 1), (None, 0, len(unit), 1)}
    clean = [(r["doc_id"], r["text"]) for r in rows_of(line_dedup.deduplicated(df))]
    assert sorted(clean, key=str) == sorted([(2, "Intro of it.  Then more."), (1, rows[1][1]), (None, ""), (4, None), (5, "short. short."),
                                             (2, "Intro of it.  Then more.")], key=str)
    assert line_dedup.repeated(empty(spark)).count() == 0
    assert line_dedup.deduplicated(docs).columns == docs.columns


def test_repeated_lines_of_short_sentences(spark):
    line = "The and attion to thanedble the, anea. Eriner thanea."  # no sentence in it reaches the floor
    long = "This sentence of many words stands in several documents here."
    rows = [(1, f"{line}\n{long} Short end."), (2, f"a\n  {line.upper()} \n...b"), (3, f"{long} Short  end.\nx {long}"), (4, f"One more. {line}"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    at = len(line) + 1
    got = sorted(tuple(r.values())[:1] + tuple(r.values())[2:] for r in rows_of(line_dedup.repeated(df)))
    # The line of document 3 goes whole, once and not with its sentence; in its next line the sentence starts with x.
    assert got == [(2, 4, 4 + len(line), 1, 0), (3, 0, len(long) + 12, 1, at)]
    clean = {r["doc_id"]: r["text"] for r in rows_of(line_dedup.deduplicated(df))}
    assert clean == {1: rows[0][1], 2: "a\n   \n...b", 3: f"\nx {long}", 4: rows[3][1], 5: None}
    assert line_dedup.repeated(df, lines=False).select("doc_id", "start").collect() == [(3, 0)]


def test_repeated_passages_of_short_sentences(spark):
    """A passage of 56 words without any sentence or line of 15; only its end alone is too short to go."""
    passage = " ".join(f"Here stands number {w} of the short ones." for w in "one two three four five six seven".split())
    lines = passage.replace(". ", ".\n")
    rows = [(1, f"An opening of its own. {passage} An end."), (2, f"Cut in the mid {passage.upper()}  Then more."), (3, f"x.\n{lines}\ny"),
            (4, "Here stands number one of the short ones. No more of it."), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.repeated(df, least_words=15).count() == 0  # single lines and sentences: nothing is found
    found = line_dedup.repeated(df, least_words=15, runs=True)
    got = {(r["doc_id"], r["start"], r["end"], r["kept_doc_id"]) for r in rows_of(line_dedup.passages(found))}
    second = 15 + passage.index("Here", 1)  # its first sentence began before
    assert got == {(2, second, 15 + len(passage), 1), (3, 3, 3 + len(passage), 1)}
    clean = {r["doc_id"]: r["text"] for r in rows_of(line_dedup.deduplicated(df, least_words=15, runs=True))}
    assert clean == {**dict(rows), 2: f"{rows[1][1][:second]}  Then more.", 3: "x.\n\ny"}
    assert line_dedup.passages(line_dedup.repeated(empty(spark), runs=True)).count() == 0


def test_runs_cover_what_is_shared_to_the_end(spark):
    import random

    draw = random.Random(5)
    sentence = lambda n: " ".join(f"word{draw.randrange(10**6)}" for _ in range(n)) + "."
    for _ in range(300):
        shared = [sentence(draw.randint(1, 20)) for _ in range(draw.randint(1, 9))]
        one, two = (" ".join([sentence(3), *shared, sentence(4)]) for _ in range(2))
        known = {d for _, _, d in line_dedup.run_units(one, 15)}
        covered = {p for s, e, d in line_dedup.run_units(two, 15) if d in known for p in range(s, e)}
        whole = " ".join(shared)
        at, shown = two.index(whole), {p for p, c in enumerate(two) if c != " "}
        assert covered & shown == (set(range(at, at + len(whole))) & shown if len(whole.split()) >= 15 else set())


# -- fertility


def test_quality_counts(spark, docs, texts):
    got = {r["doc_id"]: r["q"] for r in rows_of(docs.where("doc_id <> 3").select("doc_id", fertility.quality(F.col("text"), PIECES).alias("q")))}
    for i, text in enumerate(texts):
        if i == 3:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        covered = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        q = got[i]
        assert (q["n_words"], q["word_chars"], q["n_repeat_words"], q["n_dup_lines"]) == (
            len(words), sum(map(len, words)), len(covered), len(lines) - len(set(lines)))
        assert q["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (q["base_failed"] and q["kept"])


def test_fertility_bands():
    rng = random.Random(5)
    noise = " ".join("".join(rng.choice("𐎀𐎁𐎂𐎃𐎄") for _ in range(6)) for _ in range(80))
    rows = fertility.measure([noise.encode(), prose(rng, 60).encode()], PIECES, fertility.BANDS | {"other": fertility.Band(0.2, 5, 0.5, 2.5)})
    assert rows[0]["fallback_share"] > 0.5 and not rows[0]["kept"] and rows[1]["kept"]


def test_default_bands(spark):
    """Clean documents of the tables stay; the same texts stuffed, shouted, spaced or as noise are rejected, each in its language."""
    rng = random.Random(6)
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) between 2000 and 9000").orderBy("doc_id").collect()
    made = {
        "clean": lambda t: t, "shouted": str.upper, "spaced": lambda t: " ".join(t.replace(" ", "")),
        "stuffed": lambda t: " ".join(f"{w} {rng.choice(['***', '%%%', '$$$'])}" for w in t.split()),
        "noise": lambda t: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in w) for w in t.split()),
    }
    rows = [(kind, r["lang"], f(r["text"])) for r in table if not set("#*$%&|<>") & set(r["text"]) for kind, f in made.items()]
    df = spark.createDataFrame(rows, "kind string, lang string, text string")
    passed = df.select("kind", "lang", fertility.quality(F.col("text"), PIECES, lang=F.col("lang")).alias("q")).where("not q.base_failed")
    share = {(r["kind"], r["lang"]): r["s"] for r in passed.groupBy("kind", "lang").agg(F.avg(F.col("q.kept").cast("int")).alias("s")).collect()}
    assert {lang for _, lang in share} == set(fertility.LANGUAGES)
    for (kind, _), s in share.items():
        assert s > 0.9 if kind == "clean" else s < 0.05


# -- n-gram join


def brute_groups(rows):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)]


def test_ngram_join(spark):
    rng = random.Random(9)
    rows = [(None, "one two"), (50, "One TWO"), (51, None), (52, ""), (53, " "), (54, None)]
    base = [prose(rng, 80).split() for _ in range(4)]
    for k in range(40):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((k, " ".join(words)))
    rows += [rows[6], (60, prose(rng, 3000)), (61, "tail")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, size string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(ngram_join.groups(ngram_join.link(df)))]
    assert sorted(got, key=str) == sorted(brute_groups(rows), key=str)
    kept = rows_of(ngram_join.keep_first(df))
    assert list(kept[0]) == df.columns
    grouped = {c for _, n, c in brute_groups(rows) if n}
    assert sorted(r["doc_id"] for r in kept if (r["text"] or "").strip()) == sorted(grouped)
    assert sorted(str(r["doc_id"]) for r in kept if not (r["text"] or "").strip()) == ["51", "52", "53", "54"]


def test_ngram_join_of_nothing(spark):
    assert ngram_join.groups(ngram_join.link(empty(spark))).count() == 0


# -- language


def slow_bits(samples, text, order):
    counts = {}
    for s in samples:
        data = b" " * order + s
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[i - k : i], {}).setdefault(data[i], 0)
                counts[data[i - k : i]][data[i]] += 1
    total, data = 0.0, b" " * order + text
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k : i])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / (n + kinds))
                    break
                total -= math.log2(kinds / (n + kinds))
        else:
            total += 8
    return total


def test_code_lengths():
    samples = {"a": [b"the river and the stone", b"the light"], "b": ["der Fluß und der Stein".encode()]}
    model = langid.fit(samples)
    texts = [b"the stone", "über dem Fluß".encode(), b"", b"\x00zzz", b"x" * 700]
    got = langid.Scorer(model).code_lengths(texts)
    want = [[slow_bits(samples[k], t, langid.ORDER) for k in "ab"] for t in texts]
    assert np.allclose(got, want)


def test_language_of_held_out(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(table)
    found = table.select("lang", "doc_id", langid.held_out(F.col("doc_id")).alias("h"), langid.identify(F.col("text"), model).alias("f")).collect()
    for r in found:
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["f"]["score"] <= 1
    held = [r["lang"] == r["f"]["lang_pred"] for r in found if r["h"]]
    assert np.mean(held) > 0.9
    odd = {r["doc_id"]: r["f"]["lang_pred"] for r in docs.where("doc_id < 4 and text is null or text in ('', '   ')").select(
        "doc_id", langid.identify(F.col("text"), model).alias("f")).collect()}
    assert odd and set(odd.values()) == {"und"}


# -- token files


def test_token_files(spark, docs, texts):
    folder = token_files.write(docs, BYTE_BPE)
    got = sorted(rows_of(token_files.read(spark, folder)), key=lambda r: r["start"])
    library = Tokenizer.from_file(BYTE_BPE)
    want = sorted([(r["doc_id"], r["text"] or "") for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    by_id = {}
    for d, t in want:
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        by_id.setdefault(d, set()).add((len(ids), zlib.crc32(np.array(ids, "<u4"))))
    for r in got:
        assert r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in by_id[r["doc_id"]]
        start += r["n_tokens"]
    assert token_files.read(spark, token_files.write(empty(spark), BYTE_BPE)).count() == 0


# -- decontamination


def test_edit_match():
    assert decontaminate.edit_match(list("abcd"), list("xxabxcdyy")) == (1, 2, 7)
    assert decontaminate.edit_match(list("abc"), list("abc")) == (0, 0, 3)


def test_leaks(spark, docs):
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randrange(900)}" for _ in range(n))) for k, n in enumerate([15, 20, 28, 40, 55] * 8)] + [(98, None), (99, "")]
    rows, planted = [], set()
    for k, text in items[:40]:
        words = text.split()
        for _ in range(k % 3 if len(words) >= 20 else 0):  # up to two edits
            at = rng.randrange(1, len(words))
            words[at : at + 1] = rng.choice([[], ["other"], [words[at], "added"]])
        rows.append((k, f"{prose(rng, 30)} {' '.join(words).upper()} {prose(rng, 30)}"))
        planted.add((k, k))
    rows += [(200 + k, prose(rng, 300)) for k in range(20)] + [(None, items[0][1]), (300, None), rows[0]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in rows_of(decontaminate.matches(df, bench))}
    assert got <= planted | {(None, 0)}  # exact verification: nothing else
    assert (None, 0) in got and len(got & planted) >= 0.95 * len(planted)
    assert {(k, k) for k in range(40) if k % 3 == 0} <= got  # copies are always found
    kept = rows_of(decontaminate.clean(df, bench))
    assert {r["doc_id"] for r in kept} >= {200 + k for k in range(20)} | {300} and list(kept[0]) == df.columns
    assert decontaminate.matches(empty(spark), bench).count() == 0
    assert decontaminate.matches(df, bench.where("item_id > 90")).count() == 0


def test_recall_at_the_full_distance(spark):
    """Items of 15 to 35 words, each with as many edits as are allowed and at any word, against the exact distance."""
    rng = random.Random(12)
    items, rows, near = [], [], set()
    for k, n in enumerate([n for n in range(15, 36) for _ in range(30)]):
        item = [f"w{rng.randrange(90_000)}" for _ in range(n)]
        words = list(item)
        for _ in range(decontaminate.edits_allowed(n)):
            at, kind = rng.randrange(len(words) + 1), rng.randrange(3)
            words[at : at + (kind != 1)] = [f"new{rng.random()}"] * (kind != 2)
        text = [*prose(rng, 30).split(), *words, *prose(rng, 30).split()]
        if decontaminate.edit_match(item, text)[0] <= decontaminate.edits_allowed(n):
            near.add((k, n))
        items.append((k, " ".join(item)))
        rows.append((k, " ".join(text)))
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"] for r in decontaminate.matches(df, bench).where("doc_id = item_id").collect()}
    assert len(near) == len(items)
    for low, high in ((15, 17), (18, 21), (22, 27), (28, 35)):
        pairs = [k for k, n in near if low <= n <= high]
        assert sum(k in got for k in pairs) >= decontaminate.RECALL * len(pairs)


# -- pages


def test_blocks_and_labels(spark):
    page = ('<html><head><title>t</title></head><body><nav><a href=/>Home</a></nav><!-- x --><article><h1>A &amp; B</h1><p>First <b>part</b>,\n  with '
            'words.<p>Second one, unclosed.<script>var t="</p>";</script></article><form>Name <input></form><footer>&copy; 2020 site</footer>')
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<p>"), (5, page)], "page_id long, html string")
    got = {r["page_id"]: r["t"] for r in rows_of(df.select("page_id", html_blocks.extract(F.col("html")).alias("t")))}
    assert got[1] == "A & B\n\nFirst part, with words.\n\nSecond one, unclosed." and got[5] == got[1]
    assert got[2] == got[3] == got[4] == ""


def test_labeller_on_made_up_pages():
    with np.load(html_blocks.WEIGHTS) as weights:
        assert train_blocks.accuracy(dict(weights)) > 0.99


def test_lstm_gradient_free_equality():
    """Pages labelled together get the labels they get alone."""
    rng = np.random.default_rng(2)
    pages = [train_blocks.labelled(rng)[0] for _ in range(12)] + [np.zeros((0, html_blocks.INPUTS), np.float32)]
    labeller = html_blocks.Labeller()
    for one, many in zip([labeller.scores([p])[0] for p in pages], labeller.scores(pages), strict=True):
        assert np.allclose(one, many, atol=1e-4)


# -- word BPE


def test_word_bpe(spark, docs, texts):
    library = Tokenizer.from_file(WORD_BPE)
    found = docs.select("doc_id", "text", word_bpe.encode(F.col("text"), WORD_BPE).alias("ids")).withColumn("back", word_bpe.decode(F.col("ids"), WORD_BPE))
    for r in found.collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["back"] == library.decode(want, skip_special_tokens=False)
    assert empty(spark).select(word_bpe.encode(F.col("text"), WORD_BPE)).count() == 0


def test_verified_proposals_are_merges():
    bpe = word_bpe.tokenizer(WORD_BPE)
    rng = random.Random(8)
    words = ["".join(rng.choice("aeiouthnsr!.é") for _ in range(rng.randint(1, 90))).encode() for _ in range(800)]
    proposed, good = bpe.speculate(words)
    assert 0 < good.sum() < len(words)
    for word, tokens, ok in zip(words, proposed, good, strict=True):
        assert ok == (tokens.tolist() == list(bpe.merged(word)))


# -- queries


def test_base_spans_digest(spark):
    from playtide.llm.queries import QUERIES

    rows = rows_of(QUERIES["op1_secret_scan"](spark, "/root/testdata/sf0.001"))
    for r in rows:
        base = ",".join(s for s in r["spans"].split(",") if s and not s.startswith("entropy"))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
