"""Tables merged by bucket, and the log under concurrent ingests."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import click, deliveries, records, replay, view
from test_commands import AT, catalog, command, frame
from test_project import agrees, messages
from tallyline import schemas as S
from tallyline.plans.ingest import ingest_to_log
from tallyline.plans.model import CATALOG, MODEL, catch_up, read_catalog, read_model, update_catalog, update_model
from tallyline.plans.project import rebuild_read_model
from tallyline.session import run_dir
from tallyline.sources import event_log as L
from tallyline.sources import files
from tallyline.sources.bucketed import BucketedTables


def test_runs_add_up(spark):
    bodies, root = messages(11, 90), run_dir(spark, "test-model")
    for start in (0, 45):
        update_model(deliveries(spark, *bodies[start:start + 45], start=start), root, buckets=4)
    agrees(read_model(spark, root), replay(bodies))
    # The same deliveries once more change nothing.
    update_model(deliveries(spark, *bodies[45:], start=45), root)
    agrees(read_model(spark, root), replay(bodies))


def size(root, folders):
    return sum(f.stat().st_size for folder in folders for f in (Path(root) / folder).rglob("*.parquet"))


def test_a_small_run_rewrites_its_buckets_only(spark):
    root = run_dir(spark, "test-model")
    wide = spark.range(4000).select(F.to_json(F.struct(
        F.concat(F.lit("e"), "id").alias("event_id"), F.lit(S.CLICK).alias("event_type"), (F.col("id") % 50 + 1).cast("int").alias("anime_id"),
        F.concat(F.lit("user"), "id").alias("user_id"), F.lit("2024-01-01T00:00:00").alias("occurred_at"))).alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(None).cast("timestamp_ntz").alias("timestamp"))
    before = update_model(wide, root, buckets=32)
    after = update_model(deliveries(spark, click("new"), view("bad", -1), start=5000), root)
    for name in ("activity", "ledger"):
        old, new = before.tables[name], after.tables[name]
        changed = [b for b in new if new[b] != old.get(b)]
        assert 1 <= len(changed) <= 2 and len(new) == 32
        written = [f for b in changed for f in new[b]]
        assert size(root, written) < 2 * size(root, [f for b in changed for f in old[b]])
    assert read_model(spark, root).activity.count() == 4001
    BucketedTables(spark, root, MODEL).vacuum(keep=1)
    assert read_model(spark, root).ledger.count() == 4002


def test_two_runs_at_one_time(spark, monkeypatch):
    """The second run commits after the first one has read the manifest: the first one begins again, and nothing is lost or
    counted twice."""
    root = run_dir(spark, "test-model")
    update_model(deliveries(spark, click("a")), root, buckets=4)
    put, raced = files.put_number, []

    def late(*args, **options):
        if not raced:
            raced.append(update_model(deliveries(spark, click("b"), click("c"), start=10), root))
        return put(*args, **options)

    # The inner run's own commit passes, as `raced` is set only after it.
    def once(*args, **options):
        monkeypatch.setattr(files, "put_number", put)
        return late(*args, **options)

    monkeypatch.setattr(files, "put_number", once)
    update_model(deliveries(spark, click("b"), click("d"), start=20), root)
    model = read_model(spark, root)
    assert records(model.item_stats, "total_clicks") == [(4,)]
    assert records(model.ledger, "event_id") == [("a",), ("b",), ("c",), ("d",)]


def test_catalog(spark):
    root = run_dir(spark, "test-catalog")

    def items(*rows):
        df = spark.createDataFrame(list(rows), "myanimelist_id int, title string, episodes int, n int")
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in S.CATALOG.fields], "n")

    update_catalog(items((1, "Old", 5, 0), (3, "Kept", 6, 0)), root, "n", buckets=4)
    update_catalog(items((1, "First", 7, 1), (1, "Second", None, 2), (4, "New", 1, 1)), root, "n")
    assert records(read_catalog(spark, root), "myanimelist_id", "title", "episodes") == [
        (1, "Second", None), (3, "Kept", 6), (4, "New", 1)]
    assert BucketedTables(spark, root, CATALOG).buckets == 4


@pytest.mark.parametrize("order", ["same", "overlap"])
def test_interleaved_ingests(spark, monkeypatch, order):
    """Both ingests read the log before either commits; each id is there once and the versions go on."""
    path = run_dir(spark, "test-log")
    ingest_to_log(spark, frame(spark, command("click", "a")), catalog(spark, 1), path)
    first = [command("click", "b"), command("click", "c", at=AT.replace(hour=3))]
    second = first if order == "same" else [command("click", "c", at=AT.replace(hour=3)), command("click", "d", at=AT.replace(hour=5))]
    put = files.put_number

    def raced(*args, **options):
        monkeypatch.setattr(files, "put_number", put)
        ingest_to_log(spark, frame(spark, *second), catalog(spark, 1), path)
        return put(*args, **options)

    monkeypatch.setattr(files, "put_number", raced)
    result = ingest_to_log(spark, frame(spark, *first), catalog(spark, 1), path)
    log = L.read_log(spark, path)
    expected = 3 if order == "same" else 4
    assert log.select("event_id").distinct().count() == log.count() == expected
    assert records(log, "version") == [(i + 1,) for i in range(expected)]
    assert result.events.count() == (0 if order == "same" else 1)
    assert len(files.names(spark, f"{path}/data")) == len(L.current_version(spark, path).data)


def test_index_buckets(spark):
    path = run_dir(spark, "test-log")
    for i in range(3):
        ingest_to_log(spark, frame(spark, *[command("click", f"{i}-{j}") for j in range(20)]), catalog(spark, 1), path)
    old = L.current_version(spark, path)
    L.compact_index(spark, path)
    version = L.current_version(spark, path)
    assert len(version.ids) == 1 and version.data == old.data
    ids = L.read_log(spark, path).select("event_id")
    assert L.known_ids(spark, path, version, ids).count() == 60
    one = ids.limit(1)
    found = L.known_ids(spark, path, version, one.unionByName(spark.createDataFrame([("x",), (None,)], "event_id string")))
    assert found.count() == 1 and "bucket" in found._jdf.queryExecution().executedPlan().toString()
    assert L.read_log(spark, path, old).count() == 60


def test_catch_up_reads_the_tail_only(spark, monkeypatch):
    """A model brought up step by step equals a full rebuild; each step reads the runs that it does not hold yet."""
    log, root = run_dir(spark, "test-log"), run_dir(spark, "test-model")
    rows = [command("rating", f"r{i}", user_id=f"u{i % 3}", rating=1.0 + i, at=AT.replace(hour=i)) for i in range(8)]
    rows += [command("click", f"c{i}", user_id=f"u{i % 2}", at=AT.replace(hour=i)) for i in range(8)]
    read, seen = L.read_log, []
    for start in (0, 8, 12):
        ingest_to_log(spark, frame(spark, *rows[start:{0: 8, 8: 12, 12: 16}[start]]), catalog(spark, 1), log)
        with monkeypatch.context() as m:
            m.setattr(L, "read_log", lambda *a: seen.append(read(*a)) or seen[-1])
            catch_up(spark, log, root, buckets=4)
            catch_up(spark, log, root)
    runs = L.current_version(spark, log).data
    assert [{r for r in runs if any(r in f for f in df.inputFiles())} for df in seen] == [{"empty", runs[1]}, {runs[2]}, {runs[3]}]
    model, whole = read_model(spark, root), rebuild_read_model(L.read_log(spark, log))
    for one, other in zip(model, whole):
        shared = sorted(set(other.columns) - {"updated_at", "processed_at", "failed_at"})
        assert records(one, *shared) == records(other, *shared)


def test_no_payload_is_sorted(spark):
    """First deliveries, the ledger, new events and catalog updates stay without a sorted aggregate."""
    from tallyline.operators import catalog as K
    from tallyline.operators import classify as C
    from tallyline.operators import ledger as G

    checked = spark.createDataFrame([], S.CHECKED)
    log = spark.createDataFrame([], S.EVENT_LOG)
    items = spark.createDataFrame([], S.CATALOG)
    plans = [
        C.first_of_each(C.checked_successes(checked), spark.createDataFrame([], S.LEDGER)),
        G.merge_ledger(spark.createDataFrame([], S.LEDGER), G.ledger_entries(C.checked_attempts(checked))),
        L.new_events(log, log), K.upsert_catalog(items, items.withColumn("n", F.lit(1)), "n"),
    ]
    for plan in plans:
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
