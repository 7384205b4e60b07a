"""The stream gives the tables of the batch plan, however the deliveries are cut into micro-batches."""

import random
import re
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import click, deliveries, rating, records, replay, view
from test_project import agrees, messages
from tallyline.operators import dead_letters as D
from tallyline.operators import ledger as G
from tallyline.operators.classify import classify_events
from tallyline.plans.project import project
from tallyline.session import run_dir
from tallyline.sources import files, topic
from tallyline.streaming import projection as P


class Topic:
    """A folder of JSON files standing in for the topic, and one stream over it."""

    def __init__(self, spark):
        self.spark, self.root, self.sent = spark, run_dir(spark, "test-stream"), []
        self.place = f"{self.root}/model"

    def send(self, *bodies):
        topic.publish_files(deliveries(self.spark, *bodies, start=len(self.sent)).coalesce(1), f"{self.root}/topic")
        self.sent += bodies
        time.sleep(0.01)

    def run(self, **options):
        stream = topic.read_files(self.spark, f"{self.root}/topic", per_trigger=1)
        query = P.run_projection_stream(stream, self.place, f"{self.root}/state", availableNow=True, **options)
        query.awaitTermination()
        return query

    def model(self):
        return P.read_stream_model(self.spark, self.place)

    def counters(self):
        return records(P.read_counters(self.spark, self.place), "event_type", "outcome", "deliveries", "counter")

    def expected_counters(self):
        return records(G.processing_summary(classify_events(deliveries(self.spark, *self.sent))), "event_type", "outcome",
                       "deliveries", "counter")


@pytest.fixture
def feed(spark):
    return Topic(spark)


@pytest.mark.parametrize("compact_every", [None, 2])
def test_any_split_equals_the_batch(spark, feed, compact_every):
    bodies = messages(23, 80)
    cuts = sorted(random.Random(5).sample(range(1, 80), 2))
    for start, end in zip([0, *cuts], [*cuts, 80]):
        feed.send(*bodies[start:end])
    feed.run(compact_every=compact_every)
    agrees(feed.model(), replay(bodies))
    batch = project(deliveries(spark, *bodies))
    for streamed, whole in zip(feed.model(), batch):
        shared = sorted(set(whole.columns) - {"updated_at", "processed_at", "failed_at"})
        assert records(streamed, *shared) == records(whole, *shared)
    assert feed.counters() == feed.expected_counters()


def test_redelivery_restart_and_compaction(spark, feed):
    first = [click("a"), view("b", 5), rating("c", 8.0), view("d", -1)]
    feed.send(*first)
    feed.run()
    assert P.compact(spark, feed.place) == 0
    # Everything comes again, with one failing copy of a success and one late success of a failure.
    feed.send(*first, view("b", -7), view("d", 3))
    feed.run()
    agrees(feed.model(), replay(feed.sent))
    P.compact(spark, feed.place)
    P.compact(spark, feed.place)
    feed.send(rating("e", 2.0), click("f", user_id="u2"), click("a"))
    feed.run()
    agrees(feed.model(), replay(feed.sent))
    assert feed.counters() == feed.expected_counters()


@pytest.mark.parametrize("published", [True, False])
def test_a_batch_run_again_changes_nothing(spark, feed, published):
    feed.send(click("a"), view("b", 5), view("x", -1))
    feed.send(click("c"), click("a"), view("b", 5))
    feed.run()
    before = [records(t.drop("updated_at", "processed_at", "failed_at")) for t in feed.model()], feed.counters()
    # As after a crash before the commit of the last batch, with or without its marker.
    for name in ("1", ".1.crc"):
        (Path(feed.root) / "state" / "commits" / name).unlink(missing_ok=True)
    if not published:
        files.remove(spark, f"{feed.place}/progress/{1:020d}")
    feed.run()
    assert ([records(t.drop("updated_at", "processed_at", "failed_at")) for t in feed.model()], feed.counters()) == before
    agrees(feed.model(), replay(feed.sent))


def test_readers_see_whole_batches_between_any_two_steps(spark, feed, monkeypatch):
    """After every write of the second batch a reader still finds the first one, in all tables."""
    feed.send(click("a"), view("b", -1), view("b", 2))
    feed.run()

    def told():
        model = feed.model()
        return (records(model.item_stats, "anime_id", "total_clicks", "total_views"), records(model.ledger, "event_id", "status"),
                records(model.dead_letters, "kafka_offset"), feed.counters())

    first, seen = told(), []
    stored = P._Batch._stored

    def watched(self, *args, **options):
        out = stored(self, *args, **options)
        seen.append(told())
        return out

    monkeypatch.setattr(P._Batch, "_stored", watched)
    feed.send(click("a"), click("c"), view("d", -1), "nope", view("b", -4))
    feed.run()
    assert len(seen) == 7 and all(s == first for s in seen)
    monkeypatch.undo()
    agrees_model = replay([b for b in feed.sent if b != "nope"])
    assert told()[1] == sorted((k, v[2]) for k, v in agrees_model["ledger"].items())
    assert told()[2] == [(1,), (5,), (6,)]


def test_one_parse_per_message(spark):
    """The only plan over the raw text, and it parses once."""
    rows = P.conform(P.C.checked(P.C.classify_rows(deliveries(spark, click("a")))), P.S.CHECKED)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_empty_model(spark):
    root = run_dir(spark, "test-stream")
    P.prepare(spark, root)
    assert all(t.count() == 0 for t in P.read_stream_model(spark, root))
    assert P.read_counters(spark, root).count() == 0 and P.compact(spark, root) == P.NONE


def test_state_is_an_id_and_a_place(spark, feed):
    """Whatever the payload, an id takes three numbers; they are found again after compactions, so no copy ever counts twice."""
    long = "u" * 3000
    feed.send(*[click(f"event-with-a-long-name-{i}", user_id=f"{long}{i}") for i in range(400)])
    feed.run(compact_every=1)
    folder = Path(feed.place) / "base" / "ids" / "upto=0"
    parts = [p for p in folder.rglob("*.parquet")]
    assert P.S.SUCCEEDED_ID.fieldNames() == ["h1", "h2", "ord"] and len(parts) > 1
    rows = spark.read.parquet(str(folder))
    assert rows.count() == 400 and set(rows.columns) == {"h1", "h2", "ord", "bucket"}
    for _ in range(2):
        feed.send(click("event-with-a-long-name-7"), click("new"))
    feed.run(compact_every=1)
    assert records(feed.model().item_stats, "total_clicks") == [(401,)]


def test_lookup_reads_only_the_buckets_at_hand(spark, feed):
    feed.send(*[click(f"e{i}") for i in range(300)])
    feed.run(compact_every=1)
    found = P.succeeded_before(spark, feed.place, spark.createDataFrame([("e7",), ("x",)], "event_id string"), 5)
    assert records(found) == [("e7",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ IN \(\d+,\d+\)", plan)


def test_compaction_retires_what_two_bases_have(spark, feed):
    for i in range(4):
        feed.send(click(f"e{i}"), view("bad", -1))
    feed.run(compact_every=1)
    assert files.names(spark, f"{feed.place}/activity") == ["batch_id=-1", "batch_id=3"]
    assert files.names(spark, f"{feed.place}/base/ledger") == ["upto=2", "upto=3"]
    assert len(files.names(spark, f"{feed.place}/progress")) == 2 and files.names(spark, f"{feed.place}/checked") == []
    agrees(feed.model(), replay(feed.sent))


def test_marks_survive_batches_and_compaction(spark, feed):
    one, two, three = (datetime(2024, 2, d) for d in (1, 2, 3))
    feed.send(view("a", -1), view("b", -2), view("c", -3), view("d", -4))
    feed.run()
    letters = {r.event_id: r.dlq_id for r in feed.model().dead_letters.collect()}

    def ids(*names):
        return spark.createDataFrame([(letters[n],) for n in names], "dlq_id string")

    P.mark_letters(spark, feed.place, D.retry_marks(ids("a", "b", "a"), one))
    P.mark_letters(spark, feed.place, D.resolve_marks(ids("b", "c"), two, "seen"))
    P.mark_letters(spark, feed.place, D.retry_marks(ids("a", "c"), three))
    P.mark_letters(spark, feed.place, D.resolve_marks(ids("c"), three))
    feed.send(click("x"), view("e", -1))
    feed.run(compact_every=1)
    assert records(feed.model().dead_letters, "event_id", "status", "retry_count", "last_retry_at", "resolved_at", "notes") == [
        ("a", "retrying", 1, one, None, None), ("b", "resolved", 1, one, two, "seen"), ("c", "resolved", 0, None, three, "seen"),
        ("d", "failed", 0, None, None, None), ("e", "failed", 0, None, None, None)]


def test_late_events_count(spark, feed):
    """The second of three clicks, each in a micro-batch of its own, is dated two months earlier."""
    for i in range(3):
        feed.send(click(f"e{i}", occurred_at="2024-01-01T00:00:00" if i == 1 else f"2024-03-0{i + 1}T00:00:00"))
    feed.run()
    assert records(feed.model().item_stats, "total_clicks") == [(3,)]


def test_put_if_absent(spark):
    folder = run_dir(spark, "test-files")
    assert files.last_number(spark, folder) == -1
    assert files.put_number(spark, folder, 3, "é") and not files.put_number(spark, folder, 3, "x")
    assert files.read_number(spark, folder, 3) == "é" and files.last_number(spark, folder) == 3
    assert files.names(spark, folder) == [f"{3:020d}"]
