import gzip
import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from playtide.schemas import EVENT, pick_fields
from playtide.sources import packed_json
from playtide.sources.packed_json import parse_records, read_packed_json, records_of_chunk, records_of_line

PAIR = T.StructType([T.StructField("foo", T.StringType()), T.StructField("bar", T.StringType())])
LAYOUTS = ("packed", "lines")


def event(action, cid, started, video, progress, country, realm, customer, ts):
    data = {"cid": cid, "startedAt": started, "device": "BROWSER", "TA": "OK"}
    payload = {"action": action, "data": data, "video": video, "progress": progress, "cid": cid}
    return {"payload": payload, "country": country, "realm": realm, "customerId": customer, "ts": ts}


THREE = [
    event(2, "19ade409", 1528672255490, 11345, 5654, "US", "north.one", "qzbU", "2018-06-11 00:25:54"),
    event(2, "b55088a1", 1528676388770, 11291, 359, "FR", "north.two", "K.pM", "2018-06-11 00:25:56"),
    event(2, "704c14a3", 1528666440591, 11345, 10315, "US", "north.one", "f7bm", "2018-06-11 00:25:58"),
]


def read(spark, folder, content, layout, schema=PAIR, **options):
    (folder / "events.json").write_bytes(content.encode())
    return read_packed_json(spark, str(folder), schema, layout, **options).collect()


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("content,records", [
    ("", []),
    ("\n", []),
    ('{"foo": "bar"}', [("bar", None)]),
    ('{"foo": "bar"}{"bar": "foo"}', [("bar", None), (None, "foo")]),
    ('{"foo": "1"}\n{"foo": "2"}\n', [("1", None), ("2", None)]),
    ('{"foo": "1"}\r\n\r\n{"foo": "2"}{"foo": "3"}\r\n', [("1", None), ("2", None), ("3", None)]),
    ('\n\n{"foo": "1"}{}{}', [("1", None), (None, None), (None, None)]),
    ('{}{"foo": "1"}\n', [(None, None), ("1", None)]),
])
def test_record_boundaries(spark, tmp_path, layout, content, records):
    assert [tuple(r) for r in read(spark, tmp_path, content, layout)] == records


@pytest.mark.parametrize("layout", LAYOUTS)
def test_three_nested_events(spark, tmp_path, layout):
    content = "".join(json.dumps(e, separators=(",", ":")) for e in THREE) + "\n"
    rows = read(spark, tmp_path, content, layout, EVENT)
    assert [r.payload.video for r in rows] == [11345, 11291, 11345]
    assert [r.payload.progress for r in rows] == [5654, 359, 10315]
    assert [r.realm for r in rows] == ["north.one", "north.two", "north.one"]
    assert [r.country for r in rows] == ["US", "FR", "US"]
    assert [r.payload.data.startedAt for r in rows] == ["1528672255490", "1528676388770", "1528666440591"]
    assert str(rows[0].ts) == "2018-06-11 00:25:54"
    assert rows[0].payload.data.TA == "OK" and rows[0].payload.data.ta is None


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_boundary_inside_a_string_tears_the_record(spark, tmp_path, layout):
    rows = read(spark, tmp_path, '{"foo": "a}{b"}{"foo": "c"}', layout, corrupt="_bad")
    assert [(r.foo, r._bad) for r in rows] == [(None, '{"foo": "a}'), (None, '{b"}'), ("c", None)]


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError):
        read_packed_json(spark, str(tmp_path), layout="other")


def test_one_long_line_is_read_by_many_tasks(spark, tmp_path):
    """No record is lost or doubled where the file is split."""
    (tmp_path / "events.json").write_text("".join(json.dumps({"foo": str(i), "bar": "x" * (i % 50)}) for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_packed_json(spark, str(tmp_path), PAIR)
        assert rows.rdd.getNumPartitions() > 20
        assert rows.agg(F.count("foo"), F.countDistinct("foo"), F.sum(F.col("foo").cast("int"))).first() == (
            20000, 20000, sum(range(20000)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


text = st.text(st.characters(codec="utf-8", exclude_characters="{}\n\r"), max_size=8)
records = st.lists(st.tuples(st.dictionaries(st.sampled_from(["foo", "bar"]), text, max_size=2), st.sampled_from(["", "\n", "\n\n"])), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=records)
def test_both_ways_of_cutting_agree_with_json(spark, batch):
    content = "".join(json.dumps(value, ensure_ascii=False) + gap for value, gap in batch)
    expected = [(value.get("foo"), value.get("bar")) for value, _ in batch]
    chunks = [(i, c) for i, c in enumerate(content.split("}{")) if content]
    lines = [(i, c) for i, c in enumerate(content.split("\n"))]
    for rows, cut in ((chunks, records_of_chunk), (lines, records_of_line)):
        frame = spark.createDataFrame(rows, "i int, value string").coalesce(1)
        assert [tuple(r) for r in parse_records(frame, cut(F.col("value")), PAIR).collect()] == expected


def test_pick_fields():
    slim = pick_fields(EVENT, "realm", "payload.data.TA", "payload.action")
    assert slim.simpleString() == "struct<payload:struct<action:tinyint,data:struct<TA:string>>,realm:string>"
    with pytest.raises(ValueError):
        pick_fields(EVENT, "payload.nothing")


def test_measured_layout_per_file(spark, tmp_path):
    folder = tmp_path / "mixed [logs]"
    folder.mkdir()
    texts = [json.dumps(e, separators=(",", ":")) for e in THREE] * 20
    (folder / "a.json").write_text("".join(texts))
    (folder / "b.json").write_text("\n".join(texts) + "\n")
    (folder / "c.json").write_text(" ")
    found = packed_json.measured_layouts(spark, str(folder).replace("[", "\\[").replace("]", "\\]"))
    kinds = {file.rsplit("/", 1)[1]: kind for file, kind in found.items()}
    assert (kinds["a.json"], kinds["b.json"]) == ("packed", "lines")
    assert read_packed_json(spark, str(folder).replace("[", "\\[").replace("]", "\\]"), layout="measured").count() == 120


def test_layouts_are_told_from_the_start_of_a_file(spark, tmp_path, monkeypatch):
    texts = [json.dumps(e, separators=(",", ":")) for e in THREE] * 2000
    (tmp_path / "a.json").write_text("".join(texts) + "\n".join(texts))
    with gzip.open(tmp_path / "b.json.gz", "wt") as out:
        out.write("\n".join(texts) + "\n")
    heads, real = [], packed_json.layout_of
    monkeypatch.setattr(packed_json, "layout_of", lambda head: heads.append(len(head)) or real(head))
    found = {f.rsplit("/", 1)[1]: kind for f, kind in packed_json.measured_layouts(spark, str(tmp_path), 10_000).items()}
    assert found == {"a.json": "packed", "b.json.gz": "lines"} and heads == [10_000, 10_000]
    assert real(b'{"a":1} {"b":2}\r\n{"c":3}{"d":4}') == "lines" and real(b'{"a":{"b":1}}{"c":2}') == "packed"


def test_a_piece_without_a_cut_fails(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(e, separators=(",", ":")) for e in THREE * 50) + "\n")
    with pytest.raises(Exception, match="without a cut"):
        read_packed_json(spark, str(path), limit_bytes=5000).count()
    assert read_packed_json(spark, str(path), layout="measured", limit_bytes=5000).count() == 150


def test_a_file_of_lines_goes_to_many_tasks(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(e, separators=(",", ":")) for e in THREE * 2000) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        tasks = read_packed_json(spark, str(path), layout="measured").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) > 3 and sum(r["count"] for r in tasks) == 6000
