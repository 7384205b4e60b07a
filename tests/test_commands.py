import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import records
from tallyline import schemas as S
from tallyline.operators import commands as M
from tallyline.operators.versions import assign_versions
from tallyline.plans.ingest import ingest_commands, ingest_to_log
from tallyline.session import run_dir
from tallyline.sources import event_log as L
from tallyline.sources import topic

AT = datetime(2024, 1, 1)


def command(kind, command_id="c1", anime_id=1, user_id="user123", seconds=None, rating=None, at=AT):
    return (command_id, kind, anime_id, user_id, seconds, rating, at)


def frame(spark, *commands):
    return spark.createDataFrame(list(commands), S.COMMAND)


def catalog(spark, *ids):
    return spark.createDataFrame([(i, "t") for i in ids], "myanimelist_id int, title string")


def screened(spark, *commands):
    return records(M.screen_commands(frame(spark, *commands), catalog(spark, 1)), "reject_reason", "reject_message")


@pytest.mark.parametrize("c", [
    command("click"), command("view", seconds=3600), command("view", seconds=0),
    *[command("rating", rating=r) for r in (1.0, 5.0, 7.5, 9.5, 10.0)]])
def test_accepted(spark, c):
    assert screened(spark, c) == [(None, None)]


@pytest.mark.parametrize("c, reason, message", [
    (command("view", seconds=-1), "validation", "duration_seconds"),
    (command("view"), "validation", "duration_seconds"),
    *[(command("rating", rating=r), "validation", "rating") for r in (10.1, 11.0, 15.0, -0.1, math.nan, None)],
    (command("click", anime_id=None), "validation", "anime_id"),
    (command("click", user_id=None), "validation", "user_id"),
    (command("click", command_id=None), "validation", "command_id"),
    (command("purchase"), "validation", "command_type"),
    (command("click", anime_id=999), "AnimeNotFoundError", "Anime con ID 999 no existe"),
    # Existence is checked before the rating rule, the field rules before both.
    (command("rating", anime_id=999, rating=0.5), "AnimeNotFoundError", "Anime con ID 999 no existe"),
    (command("rating", anime_id=999, rating=11.0), "validation", "rating"),
    (command("rating", rating=0.5), "InvalidRatingError", "Calificación 0.5 no es válida. Debe estar entre 1.0 y 10.0"),
    (command("rating", rating=0.0), "InvalidRatingError", "Calificación 0.0 no es válida. Debe estar entre 1.0 y 10.0"),
])
def test_refused(spark, c, reason, message):
    assert screened(spark, c) == [(reason, message)]


def test_hot_item_is_split(spark):
    many = [command("click", f"c{i}", anime_id=1) for i in range(50)] + [command("click", "x", anime_id=2)]
    got = M.check_item_exists(frame(spark, *many), catalog(spark, 1))
    assert records(got.groupBy("anime_id", "item_exists").count()) == [(1, True, 50), (2, False, 1)]


def test_event_id_is_the_same_on_every_run(spark):
    events = M.commands_to_events(frame(spark, command("click")))
    assert events.collect() == events.collect()
    row = events.first()
    assert (row.aggregate_id, row.version, row.metadata, row.occurred_at) == ("anime_1", 1, "{}", AT)


def test_three_commands_on_one_item(spark):
    result = ingest_commands(frame(spark, command("click", "a"), command("click", "b", user_id="u2"),
                                   command("view", "c", seconds=100)), catalog(spark, 1))
    assert records(result.events, "aggregate_id", "version") == [("anime_1", 1), ("anime_1", 2), ("anime_1", 3)]
    assert result.refused.count() == 0


def test_log_is_appended_once(spark):
    path = run_dir(spark, "test") + "/log"
    first = frame(spark, command("click", "a"), command("view", "b", seconds=5), command("click", "z", anime_id=9))
    refused = ingest_to_log(spark, first, catalog(spark, 1), path).refused
    assert records(refused, "command_id") == [("z",)]
    again = frame(spark, command("click", "a"), command("rating", "c", rating=7.5), command("rating", "c", rating=7.5))
    ingest_to_log(spark, again, catalog(spark, 1), path)
    ingest_to_log(spark, frame(spark), catalog(spark, 1), path)
    log = L.read_log(spark, path)
    assert records(log, "version") == [(1,), (2,), (3,)]
    assert [r.event_type for r in log.where("version = 3").collect()] == ["RatingGiven"]
    replay = L.events_for_aggregate(log, "anime_1")
    assert [r.version for r in replay.collect()] == [1, 2, 3]
    assert L.events_for_aggregate(log, "anime_1", 5).count() == 0
    since = spark.createDataFrame([("anime_1", 1), ("anime_1", 2), ("anime_7", 0)], "aggregate_id string, from_version int")
    assert [r.version for r in L.events_for_aggregates(log, since).collect()] == [2, 3]
    assert records(topic.to_messages(log), "key") == [("anime_1",)] * 3


def test_pushdown_reaches_the_log(spark):
    path = run_dir(spark, "test") + "/log"
    L.create_log(spark, path)
    plan = L.events_for_aggregate(L.read_log(spark, path), "anime_1", 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(aggregate_id,anime_1)" in plan and "GreaterThan(version,3)" in plan


def test_json_of_an_event(spark):
    event = M.commands_to_events(frame(spark, command("view", seconds=5, at=AT.replace(microsecond=123456))))
    text = L.log_rows(event).first().event_data
    body = json.loads(text)
    assert body["occurred_at"] == "2024-01-01T00:00:00.123456"
    assert body["metadata"] == {} and body["duration_seconds"] == 5 and "rating" not in body
    assert list(body)[:6] == ["event_id", "event_type", "aggregate_id", "occurred_at", "version", "metadata"]


@pytest.mark.parametrize("burst", [False, True])
def test_versions_of_a_hot_aggregate(spark, burst):
    """A third of all events on one item; also all of them at one instant."""
    stamp = F.lit(0) if burst else (F.col("id") * 7919) % 1000
    events = spark.range(6000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "anime_1").otherwise(F.concat(F.lit("anime_"), F.col("id") % 500)).alias("aggregate_id"),
        F.timestamp_seconds(stamp).cast("timestamp_ntz").alias("occurred_at"), F.lit(1).alias("version"))
    log = spark.createDataFrame([("anime_1", 40), ("anime_1", 41)], "aggregate_id string, version int")
    got = {r.event_id: r.version for r in assign_versions(events, log).collect()}
    expected, last = {}, {"anime_1": 41}
    for r in sorted(events.collect(), key=lambda r: (r.aggregate_id, r.occurred_at, r.event_id)):
        last[r.aggregate_id] = last.get(r.aggregate_id, 0) + 1
        expected[r.event_id] = last[r.aggregate_id]
    assert got == expected
