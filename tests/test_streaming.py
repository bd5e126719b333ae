import json

import pytest
from pyspark.sql import functions as F

from playtide.operators.lookup import replace_by_name
from playtide.sources.streams import read_text_stream
from playtide.sources.tables import FolderStore
from playtide.streaming import fanout, messages, text

NOW = {"availableNow": True}


def arrival():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


@pytest.fixture
def names(spark):
    return spark.createDataFrame([("e1", "Play"), ("v1", "A")], "id string, name string")


REGISTER = {"event_name": "REGISTER_SUCCESS", "user_id": "u1", "latitude": 1.5, "experiments": [{"experiment_id": "e1", "variant_id": "v9"}]}
BEAT = {"message_type": "VIDEO_HB", "user_id": "u1", "product_id": "p1", "update_interval": 10, "experiments": []}
BUY = {"event_name": "PURCHASE_CONFIRMATION", "user_id": "u1", "event_value": "12", "event_cat_sku": "s", "experiments": []}
RATE = {"event_name": "STREAM_RATING", "user_id": "u1", "product_id": "p1", "event_value": 4, "experiments": []}
MAIL = {"role": "email-delivery", "cmd": "bounced", "recipient": "r", "smtp-timestamp": "2024-01-01T10:00:00Z"}


def frame(spark, *records):
    return spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in records], "value string")


def rows(spark, names, table, *records):
    decoded = messages.with_experiment(messages.decode_messages(frame(spark, *records)), names)
    return messages.BRANCHES[table].apply(decoded, arrival()).drop("record").collect()


def test_decode_lists_single_records_and_rubbish(spark):
    decoded = messages.decode_messages(frame(spark, [REGISTER, BEAT], BUY, "not json", "[1", '{"user_id": "x"'))
    assert decoded.count() == 6 and decoded.where("readable").count() == 3
    binary = frame(spark, [REGISTER, BEAT]).select(F.col("value").cast("binary").alias("value"))
    assert messages.decode_messages(binary).count() == 2


def test_register_rows(spark, names):
    row = rows(spark, names, "register_user", REGISTER, BEAT)[0]
    assert (row.user_id, row.geo_latitude, row.geo_longitude, row.experiment_id, row.variant_id) == ("u1", 1.5, 361.0, "Play", "")


def test_video_rows_default_to_no_time(spark, names):
    found = rows(spark, names, "video_play", BEAT, {k: v for k, v in BEAT.items() if k != "update_interval"})
    assert sorted(r.duration for r in found) == [0, 10] and {r.geo_latitude for r in found} == {181.0}


def test_purchase_and_rating_rows(spark, names):
    assert [(r.price, r.package_id) for r in rows(spark, names, "purchases", BUY, {**BUY, "event_value": "x"}, {**BUY, "event_value": 3.9})] == [(12, "s"), (None, "s"), (3, "s")]
    assert [r.rating for r in rows(spark, names, "ratings", RATE)] == [4]


def test_email_rows(spark, names):
    row = rows(spark, names, "email_status", MAIL)[0]
    assert (row.message_id, row.recipient_id, row.email_status, str(row.event_timestamp)) == ("", "r", "bounced", "2024-01-01 10:00:00")


def test_viewing_rows_and_kinds(spark, names):
    decoded = messages.with_experiment(messages.decode_messages(frame(spark, REGISTER, BEAT)), names, default=None)
    assert {(r.content_id, r.experiment_id) for r in messages.viewing_rows(decoded, arrival()).collect()} == {("register", "Play"), ("p1", None)}
    kinds = messages.decode_messages(frame(spark, REGISTER, BEAT, {**BEAT, "message_type": "VIDEO_STOP"}, BUY, RATE))
    assert [r[0] for r in kinds.select(messages.record_kind()).collect()] == ["register", "video", "video", "purchase", "other"]


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) if not isinstance(r, str) else r for r in records) + "\n")


def test_fan_out_accumulates_over_restarts(spark, names, tmp_path):
    source, store = tmp_path / "in", FolderStore(spark, str(tmp_path / "tables"))

    def run():
        stream = read_text_stream(spark, str(source), 1)
        fanout.run_to_end(fanout.start_fan_out(stream, names, store, str(tmp_path / "state"), trigger=NOW, arrival=arrival()))

    put(source, "a", [REGISTER, BEAT, BEAT], BUY, "rubbish")
    put(source, "b", [RATE, MAIL], {**BUY, "event_value": "x"})
    run()
    put(source, "c", BEAT, {**BEAT, "product_id": "p2"})
    run()
    counts = {t: store.scan(t).count() for t in ("register_user", "purchases", "ratings", "email_status")}
    assert counts == {"register_user": 1, "purchases": 1, "ratings": 1, "email_status": 1}
    log = store.scan("video_play")
    assert {(r.content_id, r.duration) for r in fanout.latest_totals(log).collect()} == {("p1", 30), ("p2", 10)}
    assert sorted(r.duration for r in log.where("content_id = 'p1'").collect()) == [20, 30]
    dead = {(r.branch, r.record[:7]) for r in store.scan(fanout.DEAD_LETTERS).collect()}
    assert dead == {(None, "rubbish"), ("purchases", '{"event')}


def viewing(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id string, content_id string, experiment_id string, variant_id string, duration bigint, event_datetime timestamp")


def test_totals_ignore_a_batch_that_comes_again(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    at = None
    first = viewing(spark, ("u", "x", "", "", 5, at), ("u", "x", "", "", 6, at))
    second = viewing(spark, ("u", "x", "", "", 4, at), ("u", "y", "", "", 1, at))
    for batch, n in ((first, 0), (second, 1), (second, 1)):
        fanout.append_totals(batch, store, "log", n, messages.VIEWING_KEYS)
        fanout.rewrite_totals(batch, store, "table", n)
    expected = {("x", 15), ("y", 1)}
    assert {(r.content_id, r.duration) for r in fanout.latest_totals(store.scan("log"), messages.VIEWING_KEYS).collect()} == expected
    assert {(r.content_id, r.duration) for r in store.scan("table").collect()} == expected


def rows_read(spark, df):
    """Rows that the files a frame reads from hold."""
    return spark.read.parquet(*df.inputFiles()).count()


def test_a_batch_reads_no_more_of_a_longer_log(spark, tmp_path):
    store, read, at = FolderStore(spark, str(tmp_path)), [], None
    for n in range(13):
        before = fanout._totals_before(store, "log", n, messages.VIEWING_KEYS, 3)
        read.append(0 if before is None else rows_read(spark, before))
        fanout.append_totals(viewing(spark, *[(f"u{k}", "x", "", "", 1, at) for k in range(10)]), store, "log", n, messages.VIEWING_KEYS, fold_every=3)
    assert read[0] == 0 and max(read) <= 10 * 3 and read[12] <= read[3]
    last = store.scan("log").where("batch_id = 12")
    assert last.count() == 10 and {r.duration for r in last.collect()} == {13}
    fanout.append_totals(viewing(spark, ("u1", "x", "", "", 5, at)), store, "log", 12, messages.VIEWING_KEYS, fold_every=3)  # again
    assert [r.duration for r in store.scan("log").where("batch_id = 12").collect()] == [17]
    # A batch from before the last fold, which a restart from an old checkpoint could bring.
    fanout.append_totals(viewing(spark, ("u1", "x", "", "", 5, at)), store, "log", 2, messages.VIEWING_KEYS, fold_every=3)
    assert [r.duration for r in store.scan("log").where("batch_id = 2").collect()] == [7]


def test_a_rewrite_keeps_the_files_of_other_buckets(spark, tmp_path):
    store, at = FolderStore(spark, str(tmp_path)), None
    files = lambda: {str(f): f.parts[-3] for f in (tmp_path / "t").rglob("*.parquet")}
    many = viewing(spark, *[(f"u{k}", "x", "", "", 1, at) for k in range(200)])
    assert fanout.rewrite_totals(many, store, "t", 0, buckets=8)
    first = files()
    assert len(set(first.values())) == 8
    one = viewing(spark, ("u7", "x", "", "", 4, at))
    assert fanout.rewrite_totals(one, store, "t", 1, buckets=8) and not fanout.rewrite_totals(one, store, "t", 1, buckets=8)
    assert first.items() <= files().items() and len({b for n, b in files().items() if n not in first}) == 1
    found = {r.user_id: r.duration for r in store.scan("t").collect()}
    assert len(found) == 200 and found["u7"] == 5 and sum(found.values()) == 204
    for n in (2, 3):
        fanout.rewrite_totals(one, store, "t", n, buckets=8)
    assert {r.user_id: r.duration for r in store.scan("t").collect()}["u7"] == 13
    touched = {b for n, b in files().items() if n not in first}
    versions = {f.parts[-2] for f in (tmp_path / "t").rglob("*.parquet") if f.parts[-3] in touched}
    assert versions == {"version=2", "version=3"}  # what the last reader may still see, and the latest


def test_a_rewrite_that_failed_comes_again(spark, tmp_path, monkeypatch):
    store, at = FolderStore(spark, str(tmp_path)), None
    fanout.rewrite_totals(viewing(spark, ("u", "x", "", "", 1, at)), store, "t", 0)
    second = viewing(spark, ("u", "x", "", "", 2, at), ("w", "x", "", "", 3, at))
    with monkeypatch.context() as broken:
        broken.setattr(FolderStore, "_name_version", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fanout.rewrite_totals(second, store, "t", 1)
    assert {(r.user_id, r.duration) for r in store.scan("t").collect()} == {("u", 1)}  # as before
    fanout.rewrite_totals(second, store, "t", 1)
    assert {(r.user_id, r.duration) for r in store.scan("t").collect()} == {("u", 3), ("w", 3)}


def test_heartbeats_are_found_without_parsing_other_records(spark, names):
    escaped = json.dumps(BEAT).replace("VIDEO_HB", "VIDEO\\u005fHB")
    lines = frame(spark, [REGISTER, BEAT, BUY], BEAT, BUY, f"[{escaped}]", "VIDEO_HB rubbish", "[1")
    found = messages.decode_heartbeats(lines)
    assert found.where("readable").where("message_type = 'VIDEO_HB'").count() == 3
    assert found.count() == 4  # and the rubbish that has the mark; nothing else was parsed
    both = [fanout.watch_totals(messages.with_experiment(d(lines), names), arrival()) for d in (messages.decode_messages, messages.decode_heartbeats)]
    assert both[0].collect() == both[1].collect() and both[0].first().duration == 30


def test_word_count_and_routes(spark):
    lines = spark.createDataFrame([("a=1&b=2&a=1",), ("",)], "value string")
    assert {r.word: r["count"] for r in text.word_count(lines, "&").collect()} == {"a=1": 2, "b=2": 1, "": 1}
    routed = spark.createDataFrame([("ONE x y",), ("TWO",), ("three four",)], "value string")
    assert [tuple(r) for r in text.first_word_routes(routed).collect()] == [("table_one", "x y"), ("table_two", None), ("table_other", "four")]


def test_running_word_count_and_batch_counts(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "tables"))
    for name, line in (("a", "x y"), ("b", "y z")):
        put(tmp_path / "in", name, line)
        lines = read_text_stream(spark, str(tmp_path / "in"))
        fanout.run_to_end([
            text.start_word_count(lines, store, "words", str(tmp_path / "s1"), trigger=NOW),
            fanout.start_batch_counts(lines, store, "counts", str(tmp_path / "s2"), NOW),
            text.start_routes(lines, store, str(tmp_path / "s3"), NOW),
        ])
    assert {r.word: r["count"] for r in store.scan("words").collect()} == {"x": 1, "y": 2, "z": 1}
    assert sorted(tuple(r) for r in store.scan("counts").collect()) == [(1, 0), (1, 1)]
    assert store.scan("table_other").count() == 2


def test_console_word_count_runs(spark, tmp_path):
    put(tmp_path / "in", "a", "x y")
    query = text.start_console_word_count(read_text_stream(spark, str(tmp_path / "in")), str(tmp_path / "s"))
    query.processAllAvailable()
    query.stop()
    assert query.lastProgress is not None


def test_a_large_lookup_joins_a_stream_without_a_broadcast(spark, names, tmp_path):
    put(tmp_path / "in", "a", "e1", "e2")
    ids = read_text_stream(spark, str(tmp_path / "in")).select(F.nullif("value", F.lit("e2")).alias("e"))
    named = replace_by_name(ids, names, "e", small=False)
    store = FolderStore(spark, str(tmp_path / "tables"))
    query = named.writeStream.foreachBatch(lambda batch, n: store.write_batch(batch, "t", n))
    fanout.run_to_end([query.option("checkpointLocation", str(tmp_path / "s")).trigger(**NOW).start()])
    assert sorted(r.e for r in store.scan("t").collect()) == ["", "Play"]
