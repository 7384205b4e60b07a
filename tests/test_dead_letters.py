from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import click, deliveries, rating, records, view
from tallyline.operators import dead_letters as D
from tallyline.plans.project import project

NOW = datetime(2024, 2, 1)


@pytest.fixture
def dlq(spark):
    sent = deliveries(spark, view("a", -1), rating("b", 11.0), click("c", user_id="absent"), start=12345)
    sent = sent.withColumn("timestamp", F.timestamp_seconds("offset").cast("timestamp_ntz"))
    return project(sent).dead_letters


def test_position_is_kept(dlq):
    assert records(dlq, "event_id", "kafka_topic", "kafka_partition", "kafka_offset", "status", "retry_count") == [
        ("a", "anime-events", 0, 12345, "failed", 0), ("b", "anime-events", 0, 12346, "failed", 0),
        ("c", "anime-events", 0, 12347, "failed", 0)]
    assert dlq.select("dlq_id").distinct().count() == 3
    assert records(dlq, "dlq_id") == records(dlq, "dlq_id")


def test_list_newest_first(dlq):
    assert [r.event_id for r in D.dlq_list(dlq, limit=2).collect()] == ["c", "b"]
    assert D.dlq_list(dlq, "archived").count() == 0
    assert D.dlq_list(dlq, "nonsense").count() == 0


def test_retry_only_from_failed(dlq):
    ids = dlq.where(F.col("event_id") == "a").select("dlq_id")
    once = D.dlq_mark_retry(dlq, ids.unionByName(ids), NOW)
    assert records(D.changed_count(once)) == [(1,)]
    assert records(once, "event_id", "status", "retry_count", "last_retry_at") == [
        ("a", "retrying", 1, NOW), ("b", "failed", 0, None), ("c", "failed", 0, None)]
    twice = D.dlq_mark_retry(once.drop("changed"), ids, NOW)
    assert records(D.changed_count(twice)) == [(0,)]
    assert records(twice.where("status = 'retrying'"), "retry_count") == [(1,)]


def test_resolve_from_any_status_and_keep_notes(spark, dlq):
    ids = dlq.where(F.col("event_id") != "c").select("dlq_id")
    noted = D.dlq_mark_resolved(dlq, ids, NOW, "first").drop("changed")
    again = D.dlq_mark_resolved(noted, ids, NOW)
    assert records(again, "event_id", "status", "notes", "resolved_at") == [
        ("a", "resolved", "first", NOW), ("b", "resolved", "first", NOW), ("c", "failed", None, None)]
    unknown = spark.createDataFrame([("no such id",)], "dlq_id string")
    assert records(D.changed_count(D.dlq_mark_resolved(dlq, unknown, NOW))) == [(0,)]
