from events import event, log, realms, ts

from playtide.operators.plays import add_durations, merge_watch_time
from playtide.plans.plays import all_live_plays, all_vod_plays, live_plays, session_durations, vod_plays

VOD, LIVE = 2, 3


def text(df):
    return sorted(map(str, df.collect()))


def test_vod_plays_and_their_audit_outputs(spark):
    events = log(
        spark,
        event(action=VOD, progress=5, at=ts(1)), event(action=VOD, progress=9, at=ts(2)), event(action=VOD, progress=7, at=ts(3)),
        event(action=VOD, progress=1, video=8), event(action=LIVE), event(realm="nowhere", action=VOD),
        event(action=VOD, cid=None), event(action=VOD, cid=""), event(action=VOD, started="soon", at=ts(1), progress=2),
    )
    plays = vod_plays(events, realms(spark))
    rows = {(r.video_id, r.started_at is None): r for r in plays.result.collect()}
    assert len(rows) == 3
    merged = rows[(7, False)]
    assert (merged.duration, merged.start_at, merged.end_at, merged.realm_id) == (9, ts(1), ts(3), 1)
    assert plays.result.columns == [
        "realm_id", "session_id", "customer_id", "video_id", "duration", "started_at", "start_at", "end_at", "country", "town"]
    assert plays.missed.count() == 1 and plays.invalid.count() == 2
    assert plays.missed.columns == events.columns


def test_live_play_duration_is_its_span(spark):
    events = log(spark, event(action=LIVE, at=ts(5)), event(action=LIVE, at=ts(1)), event(action=LIVE, device="PC"))
    rows = {r.device: r.duration for r in live_plays(events, realms(spark)).result.collect()}
    assert rows == {"TV": 240, "PC": 0}


def test_merge_extends_only_touched_sessions(spark):
    old = log(spark, event(action=VOD, progress=5, at=ts(1)), event(action=VOD, progress=3, video=8, at=ts(1)),
              event(action=VOD, cid="s2", progress=4, at=ts(1)))
    stored = vod_plays(old, realms(spark)).result
    new = log(spark, event(action=VOD, progress=4, at=ts(30)))
    merged = vod_plays(new, realms(spark), stored).result
    found = {(r.session_id, r.video_id): (r.duration, r.start_at, r.end_at) for r in merged.collect()}
    assert found == {("s1", 7): (5, ts(1), ts(30)), ("s1", 8): (3, ts(1), ts(1))}
    assert all_vod_plays(new, realms(spark), stored).count() == 3


def test_a_session_counts_as_touched_even_with_an_unknown_realm(spark):
    stored = vod_plays(log(spark, event(action=VOD, progress=5)), realms(spark)).result
    new = log(spark, event(realm="nowhere", action=VOD, progress=4))
    assert text(vod_plays(new, realms(spark), stored).result) == text(stored)


def test_live_merge_keeps_the_longest_part_unless_recomputed(spark):
    stored = live_plays(log(spark, event(action=LIVE, at=ts(0)), event(action=LIVE, at=ts(2))), realms(spark)).result
    new = log(spark, event(action=LIVE, at=ts(10)), event(action=LIVE, at=ts(13)))
    kept = live_plays(new, realms(spark), stored).result.first()
    assert (kept.duration, kept.start_at, kept.end_at) == (180, ts(0), ts(13))
    assert live_plays(new, realms(spark), stored, recompute=True).result.first().duration == 780
    assert all_live_plays(new, realms(spark), stored).first().duration == 180


def test_merging_the_same_batch_again_changes_nothing(spark):
    batch = log(spark, *[event(action=a, at=ts(m), progress=m) for a in (VOD, LIVE) for m in (1, 4, 9)])
    for build in (vod_plays, live_plays):
        once = build(batch, realms(spark)).result
        assert text(build(batch, realms(spark), once).result) == text(once)


def test_session_durations_of_both_kinds(spark):
    events = log(
        spark, event(action=VOD, progress=50, at=ts(1)), event(action=VOD, progress=20, video=9, at=ts(2)),
        event(action=LIVE, progress=999, at=ts(3)), event(action=LIVE, at=ts(5)), event(action=6), event(action=LIVE, cid=""),
    )
    sessions = session_durations(events, realms(spark))
    assert sorted(r.duration for r in sessions.result.collect()) == [50, 120]
    assert sessions.invalid.count() == 1


KEYS = ("user", "item")


def totals(spark, *rows):
    return spark.createDataFrame(list(rows), "user string, item string, duration bigint, event_datetime timestamp")


def test_watch_time_adds_to_the_latest_total_of_batch_keys(spark):
    stored = totals(spark, ("u", "x", 10, ts(1)), ("u", "x", 25, ts(2)), ("u", "y", 7, ts(1)), ("u", None, 3, ts(9)))
    batch = totals(spark, ("u", "x", 5, ts(3)), ("u", "x", 6, ts(4)), ("v", "x", 1, ts(5)), ("u", None, 2, ts(8)))
    rows = {(r.user, r.item): (r.duration, r.event_datetime) for r in merge_watch_time(batch, stored, KEYS).collect()}
    assert rows == {("u", "x"): (36, ts(4)), ("v", "x"): (1, ts(5)), ("u", None): (5, ts(9))}


def test_add_durations_covers_all_keys(spark):
    stored, batch = totals(spark, ("u", "x", 10, ts(1)), ("u", "y", 7, ts(1))), totals(spark, ("u", "x", 5, ts(1)))
    assert {(r.user, r.item): r.duration for r in add_durations(batch, stored, KEYS).collect()} == {("u", "x"): 15, ("u", "y"): 7}
