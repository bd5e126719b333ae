import json

import pytest

from playtide.plans import jobs, plays
from playtide.sources.packed_json import read_packed_json
from playtide.sources.tables import FolderStore
from test_packed_json import THREE


@pytest.fixture
def store(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "warehouse"))
    (tmp_path / "realm.csv").write_text("realm_id,name\n1,north.one\n2,north.two\n")
    jobs.load_lookup(spark, store, "realm", str(tmp_path / "realm.csv"))
    return store


def write(tmp_path, events):
    path = tmp_path / "events.json"
    path.write_text("".join(json.dumps(e, separators=(",", ":")) for e in events) + "\n")
    return str(path)


def change(event, action=None, kind=None, **more):
    copy = json.loads(json.dumps(event))
    copy["payload"]["action"] = action if action is not None else copy["payload"]["action"]
    copy["payload"]["data"].update(TA=kind or "OK", **more)
    return copy


def test_daily_jobs_from_a_packed_file(spark, store, tmp_path):
    first = THREE[0]
    path = write(tmp_path, [
        *THREE, change(first, 3), change(first, 6, "SUCCESSFUL_LOGIN"), change(first, 7, "REGISTER_USER"),
        change(first, -1, "EVENT_WENT_LIVE", DGE_EVENT_ID=4), change(first, -1, "UPDATED_VOD", vid=3, v={"tags": ["b", "a"]}),
        change(first, -1, "LIVESTREAMING_EVENT_UPDATED", v={"title": "t"}),
        change(first, -1, "SUCCESSFUL_PURCHASE", PAYMENT_PROVIDER="STRIPE", PRICE_WITH_TAX_AMOUNT=115, PRICE_WITH_TAX_CURRENCY="GBP"),
    ])
    buckets = str(tmp_path / "buckets")
    jobs.date_buckets(spark, store, path, buckets)
    for job in (jobs.event_times, jobs.signups, jobs.logins, jobs.vod_catalogue, jobs.live_catalogue, jobs.vod_plays,
                jobs.live_plays, jobs.session_durations):
        job(spark, store, path)
    jobs.purchases(spark, store, buckets)
    (tmp_path / "rates.csv").write_text("Date, USD, GBP\n11 June 2018, 1.30, 1.15\n")
    jobs.exchange_rates(spark, store, str(tmp_path / "rates.csv"), zipped=False)
    jobs.revenue_rollup(spark, store, "day")
    counts = {t: store.scan(t).count() for t in (
        "event_start", "signups", "user_logins", "vod_catalogue", "live_catalogue", "vod_play", "live_play",
        "session_duration", "payment", "subscription", "exchange_rate", "revenue_daily")}
    assert counts == {"event_start": 1, "signups": 1, "user_logins": 1, "vod_catalogue": 1, "live_catalogue": 1, "vod_play": 3,
                      "live_play": 1, "session_duration": 4, "payment": 1, "subscription": 1, "exchange_rate": 2, "revenue_daily": 1}
    assert store.scan("event_finish").isEmpty()
    revenue = store.scan("revenue_daily").first()
    assert (revenue.realm_id, revenue.amount, revenue.amount_usd, str(revenue.ts)) == (1, 115, 130, "2018-06-11 00:00:00")


def test_jobs_read_logs_of_either_layout(spark, store, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(e) for e in THREE) + "\n")
    counts = {}
    for layout in ("packed", "lines", "measured"):
        jobs.session_durations(spark, store, str(path), layout=layout)
        counts[layout] = store.scan("session_duration").count()
    assert counts == {"packed": counts["packed"], "lines": 2 * counts["packed"], "measured": 3 * counts["packed"]}


def test_payments_of_raw_events(spark, store, tmp_path):
    bought = change(THREE[0], -1, "SUCCESSFUL_PURCHASE", PAYMENT_PROVIDER="STRIPE", PRICE_WITH_TAX_AMOUNT=115, PRICE_WITH_TAX_CURRENCY="GBP")
    jobs.purchases(spark, store, read_packed_json(spark, write(tmp_path, [bought])))
    assert [(r.realm_id, r.amount_with_tax) for r in store.scan("payment").collect()] == [(1, 115)]


def test_plays_append_or_keep_the_latest(spark, store, tmp_path):
    path = write(tmp_path, THREE)
    jobs.vod_plays(spark, store, path)
    jobs.vod_plays(spark, store, path)
    assert store.scan("vod_play").count() == 6
    jobs.vod_plays(spark, store, path, keep="latest")
    jobs.vod_plays(spark, store, path, keep="latest")
    assert store.scan("vod_play").count() == 3
    jobs.live_plays(spark, store, path, keep="latest")
    assert store.scan("live_play").count() == 0


def test_dry_runs_write_nothing(spark, store, tmp_path):
    path = write(tmp_path, THREE)
    assert jobs.vod_plays(spark, store, path, dry_run=True)["vod_play"].count() == 3
    assert store.find("vod_play") is None
    assert jobs.date_buckets(spark, store, path, str(tmp_path / "none"), dry_run=True)["per_date"].first()["count"] == 3
    assert not (tmp_path / "none").exists()


def test_empty_logins_are_not_written(spark, store, tmp_path):
    jobs.logins(spark, store, write(tmp_path, THREE))
    assert store.find("user_logins") is None


def test_tournament_and_backfill_loads(spark, store, tmp_path):
    (tmp_path / "p.csv").write_text("sport_id,property_id,name\n5,1,League\n")
    (tmp_path / "t.csv").write_text("property_id,tournament_id,name\n1,10,Cup\n9,11,Other\n")
    jobs.load_lookup(spark, store, "sport_property", str(tmp_path / "p.csv"))
    jobs.load_tournaments(spark, store, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in store.scan("sport_property_tournament").collect()] == [(5, 1, 10, "Cup")]


def test_jobs_take_a_frame_parsed_once(spark, store, tmp_path):
    read_packed_json(spark, write(tmp_path, THREE)).write.parquet(str(tmp_path / "parsed"))
    events = spark.read.parquet(str(tmp_path / "parsed"))
    jobs.vod_plays(spark, store, events)
    assert store.scan("vod_play").count() == 3
    plan = plays.vod_plays(events, store.scan("realm")).result._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<country:string,customerId:string,payload:struct<action:tinyint,cid:string,data:struct<star" in plan
    assert "EqualTo(payload.action,2)" in plan


def rejected(store, job):
    return sorted((r.reason, r.realm) for r in store.scan(f"{job}_rejected").collect())


def test_jobs_write_audit_rows_and_counts(spark, store, tmp_path):
    first = THREE[0]
    unknown, nameless = {**first, "realm": "nowhere"}, change(first)
    nameless["payload"]["cid"] = ""
    lost = {**nameless, "realm": "nowhere"}
    path = write(tmp_path, [*THREE, unknown, nameless, lost, change(first, 6), change(unknown, 6)])
    counts = jobs.vod_plays(spark, store, path).counts
    assert (counts.total, counts.wanted, counts.known, counts.missed, counts.invalid) == (8, 6, 3, 1, 2)
    assert rejected(store, "vod_plays") == [("invalid", first["realm"]), ("invalid", "nowhere"), ("missed", "nowhere")]
    row = store.scan("vod_plays_rejected").where("reason = 'missed'").first()
    assert json.loads(row.event)["payload"]["cid"] == row.session_id == first["payload"]["cid"]
    assert jobs.logins(spark, store, path).counts.missed == 1 and rejected(store, "logins") == [("missed", "nowhere")]
    events = read_packed_json(spark, path)
    assert jobs.session_durations(spark, store, events).counts.total is None
    runs = {r.job: (r.total, r.wanted, r.known, r.missed, r.invalid) for r in store.scan("job_run").collect()}
    assert runs == {"vod_plays": (8, 6, 3, 1, 2), "logins": (8, 2, 1, 1, 0), "session_durations": (None, 6, 3, 1, 2)}
    shown = jobs.vod_plays(spark, store, path, dry_run=True)
    assert shown["vod_plays_rejected"].count() == 3 and store.scan("job_run").count() == 3


def test_a_run_that_comes_again_replaces_its_rows(spark, store, tmp_path):
    path = write(tmp_path, [*THREE, {**THREE[0], "realm": "nowhere"}])
    for _ in range(2):
        for job in (jobs.vod_plays, jobs.session_durations, jobs.event_times):
            job(spark, store, path, run_id="007")
    assert store.scan("vod_play").count() == 3 and store.scan("session_duration").count() == 3
    assert store.scan("vod_plays_rejected").count() == 1 and store.scan("job_run").count() == 3
    assert {r.run_id for r in store.scan("vod_play").collect()} == {"007"}
    jobs.vod_plays(spark, store, path, run_id="2018-06-12")  # a later run merges what the first one stored
    assert {r.run_id: r["count"] for r in store.scan("vod_play").groupBy("run_id").count().collect()} == {"007": 3, "2018-06-12": 3}
    jobs.vod_plays(spark, store, path)  # without an id the rows are added
    assert store.scan("vod_play").count() == 9 and store.scan("vod_play").where("run_id is null").count() == 3


def test_a_job_parses_its_log_once(spark, store, tmp_path):
    """Each file of the log is opened by one scan only: a log that is gone after the staging pass is not missed."""
    log = write(tmp_path, [*THREE, change(THREE[0], 6)])
    parsed = []
    real = jobs.read_packed_json

    def counted(*args):
        df = real(*args)
        spy = df.rdd.context.accumulator(0)
        parsed.append(spy)

        def look(batches):
            for batch in batches:
                spy.add(len(batch))
                yield batch

        return df.mapInPandas(look, df.schema)

    jobs.read_packed_json = counted
    try:
        for job in (jobs.logins, jobs.signups, jobs.vod_plays, jobs.live_plays, jobs.event_times):
            job(spark, store, log)
        jobs.date_buckets(spark, store, log, str(tmp_path / "buckets"))["per_date"].collect()
    finally:
        jobs.read_packed_json = real
    assert [spy.value for spy in parsed] == [4] * 6


def test_plays_by_date_touch_only_their_days(spark, store, tmp_path):
    day = 24 * 3600 * 1000
    other = change(THREE[0], startedAt=str(int(THREE[0]["payload"]["data"]["startedAt"]) + 5 * day))
    undated = change(THREE[0], startedAt="n/a")
    jobs.vod_plays(spark, store, write(tmp_path, [*THREE, other, undated]), keep="dates")
    stored = lambda: {str(f): f.parent.name for f in (tmp_path / "warehouse" / "vod_play").rglob("*.parquet")}
    files = stored()
    assert set(files.values()) == {"date=1970-01-01", "date=2018-06-10", "date=2018-06-11", "date=2018-06-15"}
    longer = change(other)
    longer["payload"]["progress"] = 10_000_000
    jobs.vod_plays(spark, store, write(tmp_path, [longer]), keep="dates")
    changed = {files[n] for n in files.keys() - stored().keys()}
    assert len(changed) == 1 and "date=1970-01-01" not in changed
    rows = store.scan("vod_play")
    assert rows.count() == 5 and rows.where("duration = 10000000").count() == 1
    jobs.vod_plays(spark, store, write(tmp_path, [*THREE, undated]), keep="dates")
    assert store.scan("vod_play").count() == 5
    jobs.vod_plays(spark, store, write(tmp_path, THREE), keep="append", run_id="a")
    with pytest.raises(ValueError):
        jobs.vod_plays(spark, store, write(tmp_path, THREE), keep="dates")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_rollup_and_the_play_merge_prune_by_date(spark, store, tmp_path, monkeypatch):
    bought = [change(THREE[0], -1, "SUCCESSFUL_PURCHASE", PAYMENT_PROVIDER="STRIPE", PRICE_WITH_TAX_AMOUNT=115, PRICE_WITH_TAX_CURRENCY="GBP")]
    bought.append({**bought[0], "ts": "2018-06-20 10:00:00"})
    jobs.purchases(spark, store, read_packed_json(spark, write(tmp_path, bought)))
    assert {d.name for d in (tmp_path / "warehouse" / "payment").glob("date=*")} == {"date=2018-06-11", "date=2018-06-20"}
    (tmp_path / "rates.csv").write_text("Date, USD, GBP\n11 June 2018, 1.30, 1.15\n")
    jobs.exchange_rates(spark, store, str(tmp_path / "rates.csv"), zipped=False)
    rolled = jobs.revenue_rollup(spark, store, "day", "2018-06-11 00:00:00", "2018-06-12 00:00:00", dry_run=True)["revenue_daily"]
    assert [r.amount for r in rolled.collect()] == [115]
    part = plan_of(rolled).split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2018-06-11" in part and "<= 2018-06-12" in part
    jobs.vod_plays(spark, store, write(tmp_path, THREE), keep="dates")
    plans = []
    real = FolderStore.replace_dates
    monkeypatch.setattr(FolderStore, "replace_dates", lambda self, df, table: (plans.append(plan_of(df)), real(self, df, table)))
    jobs.vod_plays(spark, store, write(tmp_path, THREE), keep="dates")
    assert "PartitionFilters: [isnotnull(date" in plans[0] and "dynamicpruning" in plans[0]


def test_empty_facts_have_their_columns(spark, store, tmp_path):
    jobs.live_plays(spark, store, write(tmp_path, THREE))
    assert store.scan("live_play").count() == 0 and "duration" in store.scan("live_play").columns
    jobs.live_plays(spark, store, write(tmp_path, [change(THREE[0], 3)]))
    assert store.scan("live_play").count() == 1
