"""Stored top lists against reports over all statistics."""

import random

import pytest

from helpers import click, deliveries, rating, records, view
from tallyline import schemas as S
from tallyline.operators import leaders as T
from tallyline.operators import reports as R
from tallyline.plans.model import MODEL, read_leaders, read_model, update_model
from tallyline.session import run_dir
from tallyline.sources import files
from tallyline.sources.bucketed import BucketedTables

SCHEMA = "anime_id int, total_clicks long, total_views long, total_ratings long, average_rating double, total_duration_seconds long"
REPORTS = {"views": R.top_by_views, "rating": R.top_by_rating}


def stats(spark, table):
    return spark.createDataFrame([(i, 0, v, n, a, 0) for i, (v, n, a) in table.items()], SCHEMA)


def test_random_changes(spark, monkeypatch):
    """Equal to the full answer after each change, ties and falling items among them; all items are ranked again only where
    too few are left."""
    monkeypatch.setattr(T, "KEPT", 6)
    monkeypatch.setattr(T, "LEAST", 3)
    random_ = random.Random(4)
    some = lambda: (random_.randint(0, 9), random_.randint(3, 8), random_.choice([0.0, 5.0, 6.25, 9.9]))
    table = {i: some() for i in range(1, 41)}
    stored, floors, full, lowest = {name: [] for name in T.LISTS}, {}, 0, 40
    for step in range(14):
        changed = {random_.randint(1, 45): some() if step % 4 else (0, 3, 0.0) for _ in range(3)}
        if step % 5 == 3:
            changed |= {r.anime_id: (0, 9, 0.0) for rows in stored.values() for r in rows[:4]}
        table |= changed
        for name in T.LISTS:
            asked = []
            kept = spark.createDataFrame(stored[name], SCHEMA)
            stored[name], floors[name] = T.updated(
                name, kept, stats(spark, changed), lambda: asked.append(1) or stats(spark, table), floors)
            full += len(asked)
            lowest = min(lowest, len(stored[name]))
            want = REPORTS[name](stats(spark, table), 3).collect()
            assert REPORTS[name](spark.createDataFrame(stored[name], SCHEMA), 3).collect() == want
            assert len(stored[name]) <= 6
    assert 2 < full < 20 and lowest >= 3


def test_lists_of_a_model(spark):
    root, n = run_dir(spark, "test-leaders"), 0
    assert records(read_leaders(spark, root, "views")) == []
    for run in range(3):
        bodies = [view(f"v{run}-{i}", anime_id=i % (7 + run) + 1) for i in range(20)]
        bodies += [rating(f"r{run}-{i}", rating=float((i * 3 + run) % 10), anime_id=i % 3 + 1, user_id=f"u{i}") for i in range(18)]
        update_model(deliveries(spark, *bodies, start=n), root, buckets=4)
        n += len(bodies)
        model = read_model(spark, root)
        for name, report in REPORTS.items():
            assert report(read_leaders(spark, root, name), 5).collect() == report(model.item_stats, 5).collect() != []


def test_runs_without_changes(spark):
    """A run of failures only, or none of whose items is rated by enough, leaves the lists as they are."""
    root = run_dir(spark, "test-leaders")
    for run, value in enumerate((8.0, 0.0)):
        rated = [rating(f"r{run}-{i}", rating=value, user_id=f"u{i}") for i in range(5)]
        update_model(deliveries(spark, *rated, start=10 * run), root, buckets=2)
        assert records(read_leaders(spark, root, "rating"), "anime_id", "average_rating") == [(1, 8.0)]
        assert read_leaders(spark, root, "views").count() == 0


def test_a_small_run_reads_its_own_buckets(spark, monkeypatch):
    """Once the lists are there, a run whose items stay behind the floor does not read all totals."""
    root = run_dir(spark, "test-leaders")
    update_model(deliveries(spark, *[view(f"v{i}", anime_id=i + 1) for i in range(30)]), root, buckets=8)
    monkeypatch.setattr(BucketedTables, "current", lambda *_: pytest.fail("all totals were read"))
    update_model(deliveries(spark, click("c"), view("w", anime_id=3), start=100), root)
    assert R.top_by_views(read_leaders(spark, root, "views"), 1).first().anime_id == 3
    assert files.last_number(spark, f"{root}/commits") == 1 and "leaders" in MODEL and S.LEADERS.fieldNames()[0] == "list"
