"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from playtide.llm import (
    best_position, chat, decontaminate, fertility, filter_audit, html_blocks, langid, line_dedup, ngram_join, secret_scan, token_files,
    tree_bpe, word_bpe,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{path}" if path else root


def query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            on_workers(spark)
            return build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op1_secret_scan(table) -> DataFrame:
    spans = F.col("spans")
    kind = lambda k: F.filter(spans, lambda s: s["kind"] == k)
    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return table("documents").select("doc_id", secret_scan.secrets(F.col("text")).alias("spans")).select(
        "doc_id",
        *(F.size(kind(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


# Control strings are counted by their first character: none of them begins inside another.
@query("""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), measured AS (
      SELECT *, length(role) + length(text) + 10
        + len(regexp_extract_all(text, '<\\\\*(\\||/?s>|/?SYS>>)')) + len(regexp_extract_all(text, '\\[\\\\*/?INST\\]'))
        + len(regexp_extract_all(text, '\\|\\\\*>')) AS chars
      FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(chars)::BIGINT AS formatted_chars
    FROM measured GROUP BY conv_id
""")
def op2_chat_format(table) -> DataFrame:
    rows = table("conversations").select("conv_id", "turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    messages = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(own).alias("content")) for r in ("user", chat.ASSISTANT)))
    extra = rows.sparkSession.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), messages.alias("messages"))
    records = rows.unionByName(extra, allowMissingColumns=True)
    found = chat.canonical(records, ("conv_id", "turn"))
    turns = found.select("conv_id", "turn", F.posexplode("turns").alias("place", "t")).select("conv_id", "turn", "place", "t.*")
    back = chat.parsed(chat.formatted(turns, "conv_id", ["turn", "place"]), "conv_id")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: Lines, and sentences of lines that stay, from so many words on.
_REPEATED_SQL = """
    WITH lines AS (
      SELECT doc_id, p.line, coalesce(sum(length(p.line) + 1) OVER (PARTITION BY doc_id ORDER BY p.place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS p(line, place)
    ), bodies AS (
      SELECT doc_id, trim(line, WHITE) AS body, pos + length(line) - length(ltrim(line, WHITE)) AS line_start FROM lines
    ), pieces AS (
      SELECT doc_id, line_start, length(body) AS size, p.piece, p.place
      FROM bodies, unnest(regexp_extract_all(' ' || body, '[^.!?\\n]+(?:[.!?]+[^.!?\\x20\\x09-\\x0D][^.!?\\n]*)*[.!?]*'))
        WITH ORDINALITY AS p(piece, place)
    ), placed AS (
      SELECT *, line_start - 1 + coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, line_start ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM pieces
    ), found AS (
      SELECT doc_id, line_start, true AS whole, line_start AS start, body FROM bodies
      UNION ALL
      SELECT doc_id, line_start, false, pos + length(piece) - length(ltrim(piece, WHITE)), trim(piece, WHITE)
      FROM placed WHERE length(trim(piece, WHITE)) < size
    ), words AS (
      SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w FROM found
    ), units AS (
      SELECT doc_id, line_start, whole, start, start + length(body) AS stop,
        translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS normal
      FROM words WHERE len(w) >= LEAST AND length(array_to_string(w, ' ')) >= 40
    ), ranked AS (
      SELECT *, first_value(doc_id) OVER g AS kept, row_number() OVER g AS n
      FROM units WINDOW g AS (PARTITION BY normal ORDER BY doc_id, start)
    ), gone AS (
      SELECT *, bool_or(whole) OVER (PARTITION BY doc_id, line_start) AS line_goes FROM ranked WHERE n > 1
    )
    SELECT doc_id, count(*) AS n_removed, sum(stop - start)::BIGINT AS chars_removed,
      string_agg(start::BIGINT || ':' || stop::BIGINT || ':' || kept, ',' ORDER BY start) AS removed
    FROM gone WHERE whole OR NOT line_goes GROUP BY doc_id
""".replace("WHITE", "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")


@query(_REPEATED_SQL.replace("LEAST", "15"))
def op3_substring_dedup(table) -> DataFrame:
    """The documents that lose text: which lines go, and which sentences of lines that stay, with their offsets and the
    document that keeps each. Shorter lines than of 15 words are left to ``op3_whole_lines``: most are formulas, which a
    clean document may hold."""
    return _removed(line_dedup.repeated(table("documents"), least_words=15))


def _removed(units: DataFrame) -> DataFrame:
    spans = F.col("removed")
    size = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    named = F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"], s["kept_doc_id"]))
    return line_dedup.by_document(units).select(
        "doc_id", F.size(spans).cast("long").alias("n_removed"), size.alias("chars_removed"), F.array_join(named, ",").alias("removed"))


@query(_REPEATED_SQL.replace("LEAST", "6"))
def op3_whole_lines(table) -> DataFrame:
    """The same with all lines of six words or more."""
    return _removed(line_dedup.repeated(table("documents")))


#: Runs of consecutive sentences that hold 15 words together, from each sentence on and up to each; those that overlap
#: as one. Fifteen words and 40 characters take at most 21 sentences.
_PASSAGES_SQL = _REPEATED_SQL[: _REPEATED_SQL.index("found AS (")] + """sentences AS (
      SELECT doc_id, pos + length(piece) - length(ltrim(piece, WHITE)) AS start, trim(piece, WHITE) AS body FROM placed
    ), words AS (
      SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w FROM sentences
    ), normalised AS (
      SELECT doc_id, start, start + length(body) AS stop, len(w) AS n,
        translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS normal
      FROM words WHERE len(w) > 0
    ), numbered AS (
      SELECT *, row_number() OVER d AS i, sum(n) OVER d AS words, sum(length(normal) + 1) OVER d AS chars
      FROM normalised WINDOW d AS (PARTITION BY doc_id ORDER BY start ROWS UNBOUNDED PRECEDING)
    ), runs AS (
      SELECT a.doc_id, a.i, b.i AS j FROM numbered a JOIN numbered b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 20
      WHERE b.words - a.words + a.n >= 15 AND b.chars - a.chars + length(a.normal) >= 40
    ), spans AS (
      SELECT doc_id, i, min(j) AS j FROM runs GROUP BY doc_id, i UNION SELECT doc_id, max(i), j FROM runs GROUP BY doc_id, j
    ), units AS (
      SELECT s.doc_id, min(start) AS start, max(stop) AS stop, string_agg(normal, ' ' ORDER BY n.i) AS normal
      FROM spans s JOIN numbered n ON n.doc_id = s.doc_id AND n.i BETWEEN s.i AND s.j GROUP BY s.doc_id, s.i, s.j
    ), ranked AS (
      SELECT *, first_value(doc_id) OVER g AS kept, row_number() OVER g AS n
      FROM units WINDOW g AS (PARTITION BY normal ORDER BY doc_id, start)
    ), gone AS (
      SELECT *, coalesce(start > max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS fresh FROM ranked WHERE n > 1
    ), joined AS (
      SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS passage FROM gone
    ), passages AS (
      SELECT doc_id, min(start) AS start, max(stop) AS stop, min(kept) AS kept FROM joined GROUP BY doc_id, passage
    )
    SELECT doc_id, count(*) AS n_removed, sum(stop - start)::BIGINT AS chars_removed,
      string_agg(start::BIGINT || ':' || stop::BIGINT || ':' || kept, ',' ORDER BY start) AS removed
    FROM passages GROUP BY doc_id
""".replace("WHITE", "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")


@query(_PASSAGES_SQL)
def op3_passages(table) -> DataFrame:
    """The same with all passages of 15 words or more in whole sentences, however short each sentence is."""
    return _removed(line_dedup.passages(line_dedup.repeated(table("documents"), least_words=15, runs=True)))


@query()
def op4_quality_fertility(table) -> DataFrame:
    return table("documents").select("doc_id", fertility.quality(F.col("text"), PIECES, lang=F.col("lang")).alias("q")).select("doc_id", "q.*")


@query()
def op7_token_files(table) -> DataFrame:
    documents = table("documents")
    return token_files.read(documents.sparkSession, token_files.write(documents, BYTE_BPE))


@query()
def op5_ngram_join(table) -> DataFrame:
    return ngram_join.groups(ngram_join.link(table("documents"))).select("doc_id", "n_shingles", "component_id")


@query()
def op6_language_id(table) -> DataFrame:
    documents = table("documents").select("doc_id", "text", "lang")
    model = langid.train(documents)
    return documents.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), langid.identify(F.col("text"), model).alias("found")
    ).select("doc_id", "held_out", "found.*")


@query()
def op8_decontamination(table) -> DataFrame:
    return decontaminate.matches(table("documents"), table("benchmark")).drop("text_hash")


@query()
def op10_word_bpe(table) -> DataFrame:
    return table("documents").select("doc_id", word_bpe.round_trip(F.col("text"), WORD_BPE).alias("t")).select(
        "doc_id",
        (F.octet_length("t.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("t.ids", 256).alias("ids_sha256"),
        F.sha2(F.col("t.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op9_html_blocks(table) -> DataFrame:
    return table("pages").select("page_id", "url", html_blocks.extract(F.col("html")).alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op11_tree_bpe(table) -> DataFrame:
    found = table("documents").select("doc_id", tree_bpe.round_trip(F.col("text"), RANKS).alias("t"))
    return found.select(
        "doc_id",
        F.size("t.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("t.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


@query("""
    WITH terms AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM documents
    ), lengths AS (
      SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
    ), whole AS (
      SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths
    ), wanted AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark
    ), counts AS (
      SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
    ), weights AS (
      SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, whole GROUP BY term
    ), impacts AS (
      SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS impact
      FROM counts JOIN weights USING (term) JOIN lengths USING (doc_id), whole
    ), scores AS (
      SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id
    ), ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
      FROM scores WHERE score > 0
    )
    SELECT * FROM ranked WHERE rank <= 10
""")
def op12_best_position(table) -> DataFrame:
    return best_position.top_documents(table("documents"), table("benchmark"))


@query("""
    WITH RECURSIVE words AS (
      SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), failed AS (
      SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
        + CASE WHEN 100 * list_unique(w) < 50 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
      FROM words
    ), cells AS (
      SELECT part, mask, count(*) AS docs,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic
      FROM failed GROUP BY part, mask
    ), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders(filter_order, applied, bits) AS (
      SELECT letter, bit, [bit] FROM letters
      UNION ALL
      SELECT filter_order || letter, applied + bit, list_append(bits, bit) FROM orders JOIN letters ON applied & bit = 0
    ), places AS (
      SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS applied
      FROM orders, range(1, 6) AS r(step) WHERE applied = 31
    ), metrics AS (
      SELECT part, filter_order, step, bit,
        coalesce(sum(docs) FILTER (mask & (applied | bit) = 0), 0)::BIGINT AS kept,
        coalesce(sum(docs) FILTER (mask & applied = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
        coalesce(sum(docs) FILTER (mask & applied <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(docs) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (mask & applied = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (mask & applied = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
      FROM cells, places GROUP BY part, filter_order, step, bit
    )
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
      (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
    FROM metrics
""")
def op13_filter_audit(table) -> DataFrame:
    return filter_audit.audit(table("documents"), table("labels"))
