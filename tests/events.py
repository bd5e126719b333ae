"""Small literal event logs."""

from datetime import datetime

from playtide.schemas import EVENT


def ts(minute, day=1):
    return datetime(2018, 6, day, 10, minute)


def event(realm="one", action=None, kind=None, at=None, cid="s1", customer="c1", **more):
    data = {name: None for name in EVENT["payload"].dataType["data"].dataType.names}
    data.update(TA=kind, device=more.pop("device", "TV"), startedAt=more.pop("started", "1528672255490"))
    top = {"country": "GB", "town": "Leeds", "clientIp": "10.0.0.1"}
    top.update({k: more.pop(k) for k in list(more) if k in top})
    payload = {"action": action, "cid": cid, "progress": more.pop("progress", None), "video": more.pop("video", 7)}
    data.update(more)
    return {**top, "customerId": customer, "payload": {**payload, "data": data}, "realm": realm, "ts": at or ts(0)}


def log(spark, *events):
    return spark.createDataFrame(list(events), EVENT)


def realms(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "realm_id int, name string")
