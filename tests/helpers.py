"""Small inputs for the tests, and the projection told as a plain loop."""

import json
from decimal import ROUND_HALF_UP, Decimal

from tallyline import schemas as S

TIME = "2024-01-01T00:00:00"


def event(kind, event_id="e1", anime_id=1, user_id="user123", occurred_at=TIME, **more):
    body = {"event_id": event_id, "event_type": kind, "aggregate_id": f"anime_{anime_id}", "anime_id": anime_id,
            "user_id": user_id, "occurred_at": occurred_at, "version": 1}
    body.update(more)
    return {k: v for k, v in body.items() if v != "absent"}


def click(event_id="e1", **more):
    return event(S.CLICK, event_id, **more)


def view(event_id="e1", duration_seconds=300, **more):
    return event(S.VIEW, event_id, duration_seconds=duration_seconds, **more)


def rating(event_id="e1", rating=8.5, **more):
    return event(S.RATING, event_id, rating=rating, **more)


def deliveries(spark, *bodies, topic="anime-events", partition=0, start=0):
    """One delivery per body, in this order; a str or None is sent as it is."""
    rows = [
        ("k", b if b is None or isinstance(b, str) else json.dumps(b), topic, partition, start + i, None)
        for i, b in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, S.DELIVERY)


def records(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def replay(bodies):
    """What one consumer would do, message by message: pairs, ledger, dead letters, outcomes."""
    done, ledger, dead, outcomes = set(), {}, [], []
    clicks, views, ratings = {}, {}, {}
    for place, e in enumerate(bodies):
        kind = e.get("event_type")
        if kind not in S.EVENT_TYPES:
            outcomes.append("unknown")
            continue
        if any(k not in e for k in S.REQUIRED_KEYS[kind]):
            dead.append(place)
            outcomes.append("invalid")
            continue
        key = e["event_id"]
        if key in done:
            outcomes.append("duplicate")
            continue
        bad = (kind == S.VIEW and e["duration_seconds"] < 0) or (
            kind == S.RATING and not 1 <= float(e["rating"]) <= 10) or e["anime_id"] is None or e["user_id"] is None
        aggregate = e.get("aggregate_id") or f"anime_{e['anime_id']}"
        opened = ledger.get(key, (kind, aggregate, None))[:2]
        if bad:
            dead.append(place)
            outcomes.append("error")
            if e.get("aggregate_id") or e["anime_id"] is not None:
                ledger[key] = (*opened, "error")
            continue
        done.add(key)
        outcomes.append("success")
        ledger[key] = (*opened, "success")
        pair = (e["anime_id"], e["user_id"])
        if kind == S.CLICK:
            clicks[pair] = (clicks.get(pair, (0,))[0] + 1, e["occurred_at"])
        elif kind == S.VIEW:
            n, total, _ = views.get(pair, (0, 0, None))
            views[pair] = (n + 1, total + e["duration_seconds"], e["occurred_at"])
        else:
            ratings[pair] = Decimal(repr(float(e["rating"]))).quantize(Decimal("0.01"), ROUND_HALF_UP)
    stats = {}
    for item in {p[0] for p in (*clicks, *views, *ratings)}:
        own = [r for p, r in ratings.items() if p[0] == item]
        mean = (sum(own) / len(own)).quantize(Decimal("0.01"), ROUND_HALF_UP) if own else Decimal(0)
        stats[item] = (
            sum(c[0] for p, c in clicks.items() if p[0] == item),
            sum(v[0] for p, v in views.items() if p[0] == item), len(own), float(mean),
            sum(v[1] for p, v in views.items() if p[0] == item))
    return {"clicks": clicks, "views": views, "ratings": ratings, "stats": stats, "ledger": ledger, "dead": dead,
            "outcomes": outcomes}
