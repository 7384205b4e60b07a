import json
import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import click, deliveries, rating, records, replay, view
from tallyline import schemas as S
from tallyline.operators import activity as A
from tallyline.operators import dead_letters as D
from tallyline.operators import ledger as G
from tallyline.operators.reports import STATS
from tallyline.operators.classify import classify_events
from tallyline.operators.dead_letters import add_dead_letters
from tallyline.plans.project import project, read_read_model, rebuild_read_model, write_read_model
from tallyline.session import run_dir


def agrees(model, told):
    assert {(r[0], r[1]): (r[2], r[3].isoformat()) for r in A.clicks_table(model.activity).collect()} == told["clicks"]
    assert {(r[0], r[1]): (r[2], r[3], r[4].isoformat()) for r in A.views_table(model.activity).collect()} == told["views"]
    assert {(r[0], r[1]): r[2] for r in A.ratings_table(model.activity).collect()} == told["ratings"]
    assert {r[0]: tuple(r)[1:] for r in model.item_stats.select(*STATS).collect()} == told["stats"]
    assert {r[0]: tuple(r)[1:4] for r in model.ledger.collect()} == told["ledger"]
    assert sorted(r.kafka_offset for r in model.dead_letters.collect()) == told["dead"]


def messages(seed, n):
    rng = random.Random(seed)

    def one():
        key = f"e{rng.randrange(n // 2 + 1)}"
        more = {"anime_id": rng.choice([1, 1, 1, 2, 3, None]), "user_id": rng.choice(["a", "b", "c", "absent"]),
                "occurred_at": f"2024-01-{rng.randrange(1, 29):02d}T00:00:00"}
        return rng.choice([
            lambda: click(key, **more), lambda: view(key, rng.randrange(-2, 9), **more),
            lambda: rating(key, rng.choice([0.5, 1, 2.345, 8.125, 10, 10.001, 7.005]), **more),
            lambda: {"event_type": "Other", "event_id": key}])()

    return [one() for _ in range(n)]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000))
def test_projection_equals_the_message_loop(spark, seed):
    bodies = messages(seed, 60)
    agrees(project(deliveries(spark, *bodies)), replay(bodies))


def test_stored_model_equals_the_lazy_one(spark):
    bodies = messages(7, 80)
    root = run_dir(spark, "test")
    write_read_model(deliveries(spark, *bodies), root)
    agrees(read_read_model(spark, root), replay(bodies))


def test_runs_add_up(spark):
    bodies = messages(11, 90)
    activity = ledger = None
    dead = []
    for start in (0, 30, 60):
        root = run_dir(spark, "test")
        write_read_model(deliveries(spark, *bodies[start:start + 30], start=start), root, activity=activity, ledger=ledger)
        model = read_read_model(spark, root)
        activity, ledger = model.activity, model.ledger
        dead += [r.kafka_offset for r in model.dead_letters.collect()]
    told = replay(bodies)
    assert sorted(dead) == told["dead"]
    assert {r[0]: tuple(r)[1:] for r in model.item_stats.select(*STATS).collect()} == told["stats"]
    assert {r[0]: tuple(r)[1:4] for r in ledger.collect()} == told["ledger"]


def test_a_user_rates_again(spark):
    model = project(deliveries(spark, rating("a", 2.0), rating("b", 9.0), rating("c", 10.0, user_id="u2")))
    assert records(model.item_stats, "total_ratings", "average_rating") == [(2, 9.5)]


def test_average_is_rounded_half_up(spark):
    model = project(deliveries(spark, rating("a", 8.12), rating("b", 8.13, user_id="u2")))
    assert records(model.item_stats, "average_rating") == [(8.13,)]


def test_last_means_last_arrived(spark):
    model = project(deliveries(spark, click("a", occurred_at="2024-05-01T00:00:00"),
                               click("b", occurred_at="2024-01-01T00:00:00")))
    assert A.clicks_table(model.activity).first().last_click_at.month == 1


def test_counters_are_long(spark):
    big = 2_000_000_000
    model = project(deliveries(spark, view("a", big), view("b", big)))
    assert records(model.item_stats, "total_duration_seconds") == [(2 * big,)]


def test_summary_counts(spark):
    bodies = [click(), click(), view("v", -1), {"event_type": "Other"}, "nope"]
    got = records(G.processing_summary(classify_events(deliveries(spark, *bodies))))
    assert got == sorted([
        ("ClickRegistered", "success", 1, "processed"), ("ClickRegistered", "duplicate", 1, "processed"),
        ("ViewRegistered", "error", 1, "error"), ("Other", "unknown", 1, "processed"),
        ("unknown", "invalid", 1, "error")], key=repr)


def test_no_sort_in_the_activity_plan(spark):
    """Activity and statistics stay hash aggregates; only the choice of the first delivery sorts."""
    plan = A.item_stats(A.merge_activity(spark.createDataFrame([], S.ACTIVITY)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_time_of_processing(spark):
    first, second = datetime(2024, 2, 1), datetime(2024, 3, 1)
    roots = run_dir(spark, "test"), run_dir(spark, "test")
    write_read_model(deliveries(spark, click("a"), view("v", -1), click("b", anime_id=2)), roots[0], first)
    earlier = read_read_model(spark, roots[0])
    write_read_model(deliveries(spark, click("a"), view("v", 4), view("w", -1), start=3), roots[1], second,
                     earlier.activity, earlier.ledger)
    later = read_read_model(spark, roots[1])
    assert records(later.item_stats, "anime_id", "updated_at") == [(1, second), (2, first)]
    assert records(later.ledger, "event_id", "status", "processed_at") == [
        ("a", "success", first), ("b", "success", first), ("v", "success", second), ("w", "error", second)]
    assert records(later.dead_letters, "event_id", "failed_at") == [("w", second)]
    both = add_dead_letters(add_dead_letters(earlier.dead_letters, later.dead_letters), later.dead_letters)
    assert records(both, "event_id") == [("v",), ("w",)]


def test_fields_of_another_type_are_ignored(spark):
    """A click may carry a rating or a duration of any size."""
    bodies = [click("a", rating=123456.0, duration_seconds=-9), view("b", 5, rating=99.0), rating("c", 7.0, duration_seconds=-1)]
    told = replay(bodies)
    agrees(project(deliveries(spark, *bodies)), told)
    root = run_dir(spark, "test")
    write_read_model(deliveries(spark, *bodies), root)
    agrees(read_read_model(spark, root), told)


def test_replay_without_versions_goes_by_time(spark):
    """All versions 1, over more than 250 days, with failing events on several aggregates."""
    bodies = [rating(f"r{i}", float(i + 1), occurred_at=f"2024-0{i + 1}-15T00:00:00") for i in range(9)]
    bodies += [view(f"bad{i}", -1, anime_id=10 + i, occurred_at="2024-01-01T00:00:00") for i in range(3)]
    rows = [(b["event_id"], b["event_type"], b["aggregate_id"], json.dumps(b),
             datetime.fromisoformat(b["occurred_at"]), 1, "{}", None, None) for b in reversed(bodies)]
    model = rebuild_read_model(spark.createDataFrame(rows, S.EVENT_LOG))
    assert [(r.anime_id, r.total_ratings, float(r.average_rating)) for r in model.item_stats.collect()] == [(1, 1, 9.0)]
    assert model.dead_letters.select("dlq_id").distinct().count() == 3


def test_second_run_keeps_dead_letters_and_their_status(spark):
    first, second = run_dir(spark, "test-model"), run_dir(spark, "test-model")
    sent = [click("a"), view("b", -1)]
    write_read_model(deliveries(spark, *sent), first)
    earlier = read_read_model(spark, first)
    marked = D.dlq_mark_resolved(earlier.dead_letters, earlier.dead_letters, datetime(2024, 2, 1)).drop("changed")
    write_read_model(deliveries(spark, view("c", -2), view("b", -1), start=1), second, activity=earlier.activity,
                     ledger=earlier.ledger, dead_letters=marked)
    assert records(read_read_model(spark, second).dead_letters, "event_id", "status") == [
        ("b", "failed"), ("b", "resolved"), ("c", "failed")]


def test_unfinished_model_is_refused(spark):
    root = run_dir(spark, "test-model")
    spark.range(1).write.parquet(f"{root}/activity")
    with pytest.raises(Exception, match="finished"):
        read_read_model(spark, root)
