import zipfile
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playtide import schemas
from playtide.plans.catalogue import vod_backfill
from playtide.plans.revenue import exchange_rates
from playtide.session import clear_work, scale_conf, work_dir, work_scope
from playtide.sources import csv
from playtide.sources.tables import CatalogStore, FolderStore, preview, staged


def test_typed_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1;"Realm; ""one"""\n2;two\n')
    rows = csv.read_typed_csv(spark, str(tmp_path), schemas.REALM, header=False, sep=";")
    assert [tuple(r) for r in rows.collect()] == [(1, 'Realm; "one"'), (2, "two")]


def test_vod_backfill(spark, tmp_path):
    header = ",".join(schemas.VOD_CATALOGUE_CSV.names)
    (tmp_path / "v.csv").write_text(header + '\n1,2,3,"A ""big"", one",text,60,http://x,1,0,2018-01-01 00:00:00,2018-01-01 00:00:00\n')
    row = vod_backfill(csv.read_typed_csv(spark, str(tmp_path), schemas.VOD_CATALOGUE_CSV)).first()
    assert (row.title, row.deleted, row.draft, row.tags, str(row.imported_at)) == ('A "big", one', True, False, None, "1970-01-01 00:00:00")


SHEET = "Date, USD, GBP, \n01 January 2018, 1.2, 0.9, \n02 January 2018, N/A, 0.8, \n"


def zipped(path, **files):
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in files.items():
            archive.writestr(f"{name}.csv", content)


def test_zipped_rates(spark, tmp_path):
    zipped(tmp_path / "a.zip", rates=SHEET)
    zipped(tmp_path / "b.zip", rates=SHEET.replace("January", "February"))
    rates = exchange_rates(csv.read_zipped_csv(spark, str(tmp_path)))
    found = {(str(r.date), r.currency, str(r.rate)) for r in rates.collect()}
    assert len(found) == 6 and ("2018-01-01", "USD", "1.2000") in found and ("2018-02-02", "GBP", "0.8000") in found


@pytest.mark.parametrize("files", [{}, {"a": SHEET, "b": SHEET}])
def test_an_archive_must_hold_one_file(spark, tmp_path, files):
    zipped(tmp_path / "a.zip", **files)
    with pytest.raises((PySparkException, ValueError), match="files, not one"):
        csv.read_zipped_csv(spark, str(tmp_path)).collect()


def test_long_archives_come_in_pieces(spark, tmp_path):
    zipped(tmp_path / "a.zip", rates="\n".join(str(i) for i in range(25001)))
    lines = csv.archive_lines(spark.read.format("binaryFile").load(str(tmp_path)))
    assert lines.agg(F.count("*"), F.max("line_no"), F.sum(F.col("line").cast("int"))).first() == (25001, 25000, sum(range(25001)))


def test_wide_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(SHEET)
    assert exchange_rates(csv.read_wide_csv(spark, str(tmp_path))).count() == 3


def test_key_values_last_line_wins(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x,1\ny,2,ignored\nbroken\nx,3\n")
    (tmp_path / "b.txt").write_text("y,9\n")
    rows = {r.id: r.name for r in csv.read_key_values(spark, str(tmp_path)).collect()}
    assert rows == {"x": "3", "y": "9"}


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def values(df):
    return sorted(r.n for r in df.select("n").collect())


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_stores(spark, tmp_path, kind):
    if kind == "folder":
        store = FolderStore(spark, str(tmp_path / "tables"))
    else:
        spark.sql("create database if not exists play")
        store = CatalogStore(spark, "play")
    assert store.find("t") is None
    store.append(rows(spark, 1), "t")
    assert store.append_if_any(rows(spark, 2), "t") and not store.append_if_any(rows(spark).limit(0), "t")
    assert values(store.scan("t")) == [1, 2]
    store.write_batch(rows(spark, 5), "b", 0)
    store.write_batch(rows(spark, 6, 7), "b", 1)
    store.write_batch(rows(spark, 6, 8), "b", 1)
    assert values(store.scan("b")) == [5, 6, 8]
    store.append(rows(spark, 5), "runs", "a-day")
    for _ in range(2):
        store.append(rows(spark, 6, 8), "runs", "007" if kind == "folder" else "it's \\ 007")
    assert values(store.scan("runs")) == [5, 6, 8]
    assert {r.run_id for r in store.scan("runs").collect()} == {"a-day", "007" if kind == "folder" else "it's \\ 007"}
    if kind == "folder":
        with pytest.raises(ValueError):
            store.append(rows(spark, 1), "runs", "a/day")
    store.replace(rows(spark, 1, 2), "r")
    store.replace(store.scan("r").select((F.col("n") * 10).alias("n")), "r")
    assert values(store.scan("r")) == [10, 20]
    for _ in range(3):
        store.replace(store.scan("r").select((F.col("n") + 1).alias("n")), "r")
    assert values(store.scan("r")) == [13, 23]


def test_a_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(LookupError):
        FolderStore(spark, str(tmp_path)).scan("nothing")


def test_preview(spark):
    assert preview(spark.range(50)).count() == 20 and preview(spark.range(50), 3).count() == 3


def test_work_dirs_lie_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_scale_conf():
    small, large = scale_conf(10**9, 8), scale_conf(100 * 10**12, 4000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert small[key] == "24" and large[key] == "745059"


def test_rows_appended_after_a_replace_are_kept(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    three = spark.range(3)
    store.append(three, "t")
    store.replace(store.scan("t"), "t")
    store.append(three, "t")
    assert store.scan("t").count() == 6


def test_rows_of_all_kinds_are_found_after_a_replace(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "kinds"))
    rows = lambda n: spark.range(n).withColumnRenamed("id", "n")
    store.write_batch(rows(3), "t", 0)
    store.replace(rows(3), "t")
    store.write_batch(rows(5), "t", 1)
    store.append(rows(2), "t")
    store.append(rows(4), "t", "0012")
    store.append(rows(7), "t", "0012")
    store.write_batch(rows(6), "t", 1)
    found = store.scan("t")
    assert found.count() == 3 + 6 + 2 + 7 and found.columns[0] == "n"
    assert {(r.batch_id, r.run_id): r["count"] for r in found.groupBy("batch_id", "run_id").count().collect()} == {
        (None, None): 5, (1, None): 6, (None, "0012"): 7}
    store.replace(rows(1), "t")
    assert store.scan("t").count() == 1


def test_a_quoted_title_holds_the_separator(spark):
    lines = spark.createDataFrame([("z", "f", 0, 'Date,"GBP, new","a ""b"""'), ("z", "f", 1, '01 Jan 2018,"1,5","x ""y"""')],
                                  "path string, entry string, line_no long, line string")
    wide = csv.lines_to_wide(lines)
    assert wide.columns == ["Date", "GBP, new", 'a "b"'] and tuple(wide.first()) == ("01 Jan 2018", "1,5", 'x "y"')


def test_batches_are_compacted_but_for_the_last(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path))
    for n in range(5):
        store.write_batch(spark.range(n + 1), "t", n)
    before = sorted((r.id, r.batch_id) for r in store.scan("t").collect())
    assert store.compact_batches("t") == 4
    assert sorted((r.id, r.batch_id) for r in store.scan("t").collect()) == before
    assert len([f for f in (tmp_path / "t__v1").iterdir() if f.name.startswith("batch_id=")]) == 1
    store.write_batch(spark.range(2), "t", 4)  # the last one comes again
    store.write_batch(spark.range(1), "t", 5)
    assert {r.batch_id: r["count"] for r in store.scan("t").groupBy("batch_id").count().collect()} == {0: 1, 1: 2, 2: 3, 3: 4, 4: 2, 5: 1}
    assert store.batches("t", 1, 5).count() == 3 + 4 + 2
    assert store.compact_batches("t") == 1 and store.compact_batches("t") == 0
    assert store.scan("t").count() == 13


def test_staged_rows_are_removed(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    with pytest.raises(ZeroDivisionError), work_scope(spark):
        inside = staged(spark.range(5), "inside")
        assert inside.count() == 5 and list(base.glob("playtide/inside-*"))
        1 / 0
    assert not list(base.glob("playtide/inside-*"))
    outside = staged(spark.range(5), "outside")
    assert outside.count() == 5
    clear_work(spark)
    assert not list(base.glob("playtide/outside-*"))
