from datetime import date

import pytest
from events import event, log, realms, ts
from pyspark.sql import functions as F

from playtide.operators.lookup import event_metrics
from playtide.plans import accounts, bucketing, catalogue
from playtide.schemas import BUCKETED_EVENT
from playtide.sources.packed_json import read_json


def test_logins(spark):
    events = log(spark, event(action=6, kind="SUCCESSFUL_LOGIN"), event(action=6, kind="FAILED_LOGIN"), event(action=6),
                 event(realm="nowhere", action=6), event(action=7, kind="SUCCESSFUL_LOGIN"))
    logins = accounts.logins(events, realms(spark))
    assert sorted(r.is_success for r in logins.result.collect()) == [False, False, True]
    assert logins.result.columns == ["realm_id", "town", "country", "client_ip", "device", "ts", "is_success", "customer_id"]
    assert logins.missed.count() == 1


def test_signups(spark):
    signups = accounts.signups(log(spark, event(kind="REGISTER_USER"), event(kind="OK")), realms(spark))
    assert [tuple(r) for r in signups.result.collect()] == [(1, "Leeds", "GB", ts(0), "TV", "c1")]


def bought(**more):
    return event(kind="SUCCESSFUL_PURCHASE", PRICE_WITH_TAX_AMOUNT=799.9, PRICE_WITH_TAX_CURRENCY="GBP",
                 PAYMENT_PROVIDER="STRIPE", SKU="month", TRIAL_DAYS=7, IS_TRIAL=True, **more)


def test_purchases_are_distinct_and_tied_by_id(spark):
    events = log(spark, bought(), bought(), bought(customer="c2"), bought(realm="nowhere"), event(kind="OK"))
    both = accounts.purchases(events, realms(spark))
    assert both.payments.count() == both.subscriptions.count() == 3
    assert {r.amount_with_tax for r in both.payments.collect()} == {799}
    assert both.payments.where("realm_id is null").count() == 1
    ids = both.payments.select("payment_id")
    assert ids.distinct().count() == 3 and ids.exceptAll(both.subscriptions.select("payment_id")).isEmpty()
    with pytest.raises(ValueError):
        accounts.purchases(events)


def test_events_with_a_realm_id_need_no_lookup(spark):
    events = log(spark, bought()).withColumn("realm_id", F.lit(42))
    assert accounts.purchases(events).payments.first().realm_id == 42


def test_event_times(spark):
    events = log(spark, event(kind="EVENT_WENT_LIVE", DGE_EVENT_ID=5, at=ts(1)), event(kind="EVENT_WENT_NOTLIVE", DGE_EVENT_ID=5, at=ts(9)),
                 event(realm="nowhere", kind="EVENT_WENT_LIVE"), event(kind="OK"))
    times = catalogue.event_times(events, realms(spark))
    assert [tuple(r) for r in times.starts.collect()] == [(5, 1, ts(1))]
    assert [tuple(r) for r in times.finishes.collect()] == [(5, 1, ts(9))]
    assert times.missed.count() == 1


VIDEO = {"title": "Final", "eventId": 9, "startDate": ts(0), "endDate": ts(30), "deleted": False, "tags": ["b", "a"],
         "geoRestriction": {"geoRestrictionType": "BLACKLIST", "countries": ["US", "FR"]}, "vodDveId": 3, "duration": 60}


def test_catalogues(spark):
    events = log(spark, event(kind="LIVESTREAMING_EVENT_UPDATED", v=VIDEO), event(kind="LIVESTREAMING_EVENT_UPDATED"),
                 event(kind="NEW_VOD_FROM_DVE", v=VIDEO, vid=1), event(kind="UPDATED_VOD", v=VIDEO, vid=2))
    live = catalogue.live_catalogue(events, realms(spark)).result.orderBy(F.col("title").desc()).collect()
    assert (live[0].duration, live[0].geo_restriction_countries, live[0].event_id) == (1800, "FR,US", 9)
    assert live[1].title is None and live[1].geo_restriction_countries is None
    vod = catalogue.vod_catalogue(events, realms(spark)).result.orderBy("video_id").collect()
    assert [(r.video_id, r.tags, r.imported_at, r.updated_at) for r in vod] == [(1, "a,b", ts(0), ts(0)), (2, "a,b", None, ts(0))]


def test_buckets_round_trip_with_all_fields(spark, tmp_path):
    events = log(spark, bought(at=ts(1)), event(kind="OK", at=ts(1, 2), ta="x"), event(realm="nowhere"))
    buckets = bucketing.bucket_events(events, realms(spark))
    bucketing.write_buckets(buckets.events, str(tmp_path / "out"))
    bucketing.write_buckets(buckets.events, str(tmp_path / "out"))
    assert (tmp_path / "out/year=2018/month=06/day=02/hour=10").is_dir()
    back = read_json(spark, str(tmp_path / "out"), BUCKETED_EVENT)
    assert back.count() == 4 and back.columns == BUCKETED_EVENT.names
    once = back.dropDuplicates(["ts"]).select(buckets.events.columns)
    assert sorted(map(str, once.collect())) == sorted(map(str, buckets.events.collect()))
    day = back.where("day = '02'")
    assert "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in buckets.per_date.collect()] == [("2018-06-01", 1), ("2018-06-02", 1)]
    assert buckets.missed.count() == 1


def test_high_water_mark(spark):
    table = spark.createDataFrame([(ts(1),), (ts(1, 9),)], "start_at timestamp")
    assert bucketing.high_water_mark(table).first().day == "2018/06/09"
    today = F.lit(date(2024, 3, 1))
    assert bucketing.high_water_mark(table.limit(0), today=today).first().day == "2024/02/29"


def test_metrics_add_up(spark):
    events = log(spark, event(), event(realm="nowhere"), event(cid=""), event(cid=None))
    assert tuple(event_metrics(events, realms(spark)).first()) == (4, 3, 1, 2)
