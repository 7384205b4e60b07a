"""One registered query per operator; each reads whole driver tables from `sf_dir`."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import activity as A
from tallyline.operators import catalog as C
from tallyline.operators import classify as K
from tallyline.operators import commands as M
from tallyline.operators import dead_letters as D
from tallyline.operators import ledger as G
from tallyline.operators import reports as R
from tallyline.operators.versions import assign_versions
from tallyline.plans import catalog as catalog_plan
from tallyline.plans.ingest import ingest_commands, ingest_to_log
from tallyline.plans.model import catch_up, read_catalog, read_leaders, read_model, update_catalog, update_model
from tallyline.plans.project import check_deliveries, project, read_read_model, rebuild_read_model, write_read_model
from tallyline.session import materialize, run_dir
from tallyline.sources import event_log as L
from tallyline.sources import topic
from tallyline.sources.catalog_csv import write_catalog_csv
from tallyline.streaming import projection as P
from tallyline.workload import inputs as I

# An earlier run covers the events before this moment.
CUT = datetime(2024, 1, 16)
NOW = datetime(2024, 2, 1)
LATER = datetime(2024, 2, 2)
DIGIT = "7"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def registered(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return add


# ---- shared steps ----------------------------------------------------------------------


def _checked(spark, sf_dir):
    return check_deliveries(I.deliveries(spark, sf_dir))


def _successes(spark, sf_dir):
    return K.first_of_each(K.checked_successes(_checked(spark, sf_dir)))


def _stats(spark, sf_dir):
    return A.item_stats(A.activity(_successes(spark, sf_dir))).select(*R.STATS)


def _before(df, column="timestamp"):
    return df.where(F.col(column) < F.lit(CUT))


def _after(df, column="timestamp"):
    return df.where(F.col(column) >= F.lit(CUT))


def _plain(df):
    return df.withColumn("rating", F.col("rating").cast("double"))


def _doubles(df, *columns):
    """Integers that may be NULL, as doubles: a data frame library would make them so on one side only."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _dlq(spark, sf_dir):
    return project(I.deliveries(spark, sf_dir)).dead_letters


def _stored(deliveries):
    root = run_dir(deliveries.sparkSession, "model")
    write_read_model(deliveries, root)
    return read_read_model(deliveries.sparkSession, root)


def _log(spark, sf_dir):
    result = ingest_commands(I.commands(spark, sf_dir), I.catalog(spark, sf_dir))
    return L.log_rows(result.events)


# ---- projections -----------------------------------------------------------------------


@registered("clicks_by_item_user")
def clicks_by_item_user(spark, sf_dir):
    return A.clicks_by_item_user(_successes(spark, sf_dir))


@registered("views_by_item_user")
def views_by_item_user(spark, sf_dir):
    return A.views_by_item_user(_successes(spark, sf_dir))


@registered("latest_ratings")
def latest_ratings(spark, sf_dir):
    return _plain(A.latest_ratings(_successes(spark, sf_dir)))


@registered("activity")
def activity(spark, sf_dir):
    return _plain(A.activity(_successes(spark, sf_dir)).drop("click_ord", "view_ord", "rating_ord", "updated_at"))


@registered("item_stats")
def item_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@registered("incremental_item_stats")
def incremental_item_stats(spark, sf_dir):
    """An earlier run, stored, then the rest on top of its activity and ledger."""
    every = I.deliveries(spark, sf_dir)
    earlier = _stored(_before(every))
    return project(_after(every), activity=earlier.activity, ledger=earlier.ledger).item_stats.select(*R.STATS)


@registered("classify_events")
def classify_events(spark, sf_dir):
    return K.resolve_duplicates(_checked(spark, sf_dir)).select(
        "topic", "partition", "offset", "event_id", "event_type", "outcome")


@registered("missing_fields")
def missing_fields(spark, sf_dir):
    return K.checked_rejects(_checked(spark, sf_dir)).where(F.col("verdict") == "invalid").select(
        "offset", "event_type", "error_type", "error_message")


@registered("drop_processed")
def drop_processed(spark, sf_dir):
    rows = _checked(spark, sf_dir)
    earlier = G.ledger_entries(K.checked_attempts(_before(rows)))
    return K.drop_processed(rows, earlier).select("offset", "event_id", "verdict")


@registered("ledger")
def ledger(spark, sf_dir):
    return project(I.deliveries(spark, sf_dir)).ledger.drop("processed_at")


@registered("incremental_ledger")
def incremental_ledger(spark, sf_dir):
    """All deliveries come again after a stored run over the first part."""
    every = I.deliveries(spark, sf_dir)
    return project(every, ledger=_stored(_before(every)).ledger).ledger.drop("processed_at")


def _bucketed_model(spark, sf_dir):
    """An earlier run, then the rest, then all deliveries once more: three commits of a model in buckets."""
    return read_model(spark, _bucketed_root(spark, sf_dir))


def _bucketed_root(spark, sf_dir):
    root = run_dir(spark, "model")
    every = I.deliveries(spark, sf_dir)
    for part in (_before(every), _after(every), every):
        update_model(part, root, buckets=16)
    return root


@registered("bucketed_item_stats")
def bucketed_item_stats(spark, sf_dir):
    return _bucketed_model(spark, sf_dir).item_stats.select(*R.STATS)


@registered("stored_top_by_views")
def stored_top_by_views(spark, sf_dir):
    """From the list that the runs have kept, not from all statistics."""
    return R.top_by_views(read_leaders(spark, _bucketed_root(spark, sf_dir), "views"))


@registered("stored_top_by_rating")
def stored_top_by_rating(spark, sf_dir):
    return R.top_by_rating(read_leaders(spark, _bucketed_root(spark, sf_dir), "rating"))


@registered("bucketed_ledger")
def bucketed_ledger(spark, sf_dir):
    return _bucketed_model(spark, sf_dir).ledger.drop("processed_at")


@registered("bucketed_dead_letters")
def bucketed_dead_letters(spark, sf_dir):
    return _bucketed_model(spark, sf_dir).dead_letters


@registered("processing_summary")
def processing_summary(spark, sf_dir):
    return G.processing_summary(K.resolve_duplicates(_checked(spark, sf_dir)))


@registered("rebuild_read_model")
def rebuild_stats(spark, sf_dir):
    return rebuild_read_model(_log(spark, sf_dir)).item_stats.select(*R.STATS)


@registered("rebuild_unversioned")
def rebuild_unversioned(spark, sf_dir):
    """The versions of the log were never assigned: it is replayed by time."""
    log = _log(spark, sf_dir).withColumn("version", F.lit(1))
    return rebuild_read_model(log).item_stats.select(*R.STATS)


def _streamed(spark, sf_dir, compact=True):
    """The deliveries are published in three parts. After each the query starts again and runs until the topic is used up;
    the second time the model is compacted. The folder of the stored model."""
    root = run_dir(spark, "stream")
    every = I.deliveries(spark, sf_dir)
    last = every.agg(F.max("offset")).first()[0] or 0
    # The parts follow the offsets; a cut after an even one parts the two deliveries of an event.
    cuts = [-1, last // 3 // 2 * 2, 2 * last // 3 // 2 * 2, last]
    for number, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        topic.publish_files(every.where(F.col("offset").between(low + 1, high)), f"{root}/topic")
        stream = topic.read_files(spark, f"{root}/topic")
        P.run_projection_stream(stream, f"{root}/model", f"{root}/state", availableNow=True).awaitTermination()
        if compact and number == 1:
            P.compact(spark, f"{root}/model")
    return f"{root}/model"


@registered("stream_projection")
def stream_projection(spark, sf_dir):
    return P.read_stream_model(spark, _streamed(spark, sf_dir)).item_stats.select(*R.STATS)


@registered("stream_ledger")
def stream_ledger(spark, sf_dir):
    return P.read_stream_model(spark, _streamed(spark, sf_dir)).ledger.drop("processed_at")


@registered("stream_dead_letters")
def stream_dead_letters(spark, sf_dir):
    return P.read_stream_model(spark, _streamed(spark, sf_dir)).dead_letters.drop("failed_at")


@registered("stream_counters")
def stream_counters(spark, sf_dir):
    return P.read_counters(spark, _streamed(spark, sf_dir))


@registered("stream_letters_marked")
def stream_letters_marked(spark, sf_dir):
    """Views are marked for a retry, then everything that names an aggregate is resolved; the model is compacted afterwards."""
    root = _streamed(spark, sf_dir, compact=False)
    letters = P.read_stream_model(spark, root).dead_letters
    P.mark_letters(spark, root, D.retry_marks(letters.where(F.col("event_type") == "ViewRegistered"), NOW))
    P.mark_letters(spark, root, D.resolve_marks(letters.where(F.col("aggregate_id").isNotNull()), LATER, "revisado"))
    P.compact(spark, root)
    return P.read_stream_model(spark, root).dead_letters.select(
        "kafka_offset", "status", "retry_count", "last_retry_at", "resolved_at", "notes")


# ---- reports ---------------------------------------------------------------------------


@registered("top_by_views")
def top_by_views(spark, sf_dir):
    return R.top_by_views(_stats(spark, sf_dir))


@registered("top_by_rating")
def top_by_rating(spark, sf_dir):
    return R.top_by_rating(_stats(spark, sf_dir))


@registered("shape_stats")
def shape_stats(spark, sf_dir):
    return R.shape_stats(_stats(spark, sf_dir))


@registered("shape_item")
def shape_item(spark, sf_dir):
    return R.shape_item(I.catalog(spark, sf_dir))


@registered("stats_for_ids")
def stats_for_ids(spark, sf_dir):
    ids = I.table(spark, sf_dir, "part").select((F.col("p_partkey") + 1).cast("int").alias("anime_id"))
    return R.stats_for_ids(_stats(spark, sf_dir), ids)


@registered("item_for_ids")
def item_for_ids(spark, sf_dir):
    ids = I.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + 1).cast("int").alias("anime_id"))
    return R.shape_item(C.items_for(I.catalog(spark, sf_dir), ids))


@registered("item_detail")
def item_detail(spark, sf_dir):
    detail = R.item_detail(I.catalog(spark, sf_dir), _stats(spark, sf_dir))
    return _doubles(detail, "episodes", "popularity", "total_clicks", "total_views", "total_ratings",
                    "total_duration_seconds")


@registered("top_items")
def top_items(spark, sf_dir):
    top = R.shape_stats(R.top_by_views(_stats(spark, sf_dir)))
    return _doubles(R.top_items(top, I.catalog(spark, sf_dir)), "episodes", "popularity")


@registered("search_items")
def search_items(spark, sf_dir):
    return R.search_items(_stats(spark, sf_dir), DIGIT)


@registered("stats_chart_data")
def stats_chart_data(spark, sf_dir):
    return R.stats_chart_data(_stats(spark, sf_dir))


@registered("dashboard_totals")
def dashboard_totals(spark, sf_dir):
    return R.dashboard_totals(_stats(spark, sf_dir))


@registered("dashboard_table")
def dashboard_table(spark, sf_dir):
    return R.dashboard_table(R.top_by_rating(_stats(spark, sf_dir)))


# ---- dead letters ----------------------------------------------------------------------


@registered("dead_letters")
def dead_letters(spark, sf_dir):
    return _dlq(spark, sf_dir)


@registered("incremental_dead_letters")
def incremental_dead_letters(spark, sf_dir):
    """All letters of a stored run over the first part are resolved; then all deliveries come again."""
    every = I.deliveries(spark, sf_dir)
    earlier = _stored(_before(every))
    resolved = D.dlq_mark_resolved(earlier.dead_letters, earlier.dead_letters, NOW, "revisado").drop("changed")
    root = run_dir(spark, "model")
    write_read_model(every, root, activity=earlier.activity, ledger=earlier.ledger, dead_letters=resolved)
    return read_read_model(spark, root).dead_letters


@registered("dlq_list")
def dlq_list(spark, sf_dir):
    return D.dlq_list(_dlq(spark, sf_dir), "failed").select(
        "event_id", "event_type", "error_message", "kafka_partition", "kafka_offset", "failed_at", "status")


def _state(dlq):
    return dlq.select("kafka_offset", "status", "retry_count", "last_retry_at", "resolved_at", "notes", "changed")


@registered("dlq_mark_retry")
def dlq_mark_retry(spark, sf_dir):
    dlq = _dlq(spark, sf_dir)
    return _state(D.dlq_mark_retry(dlq, dlq.where(F.col("event_type") == "ViewRegistered"), NOW))


@registered("dlq_mark_resolved")
def dlq_mark_resolved(spark, sf_dir):
    """Views are retried, then everything that names an aggregate is resolved."""
    dlq = _dlq(spark, sf_dir)
    retried = D.dlq_mark_retry(dlq, dlq.where(F.col("event_type") == "ViewRegistered"), NOW).drop("changed")
    return _state(D.dlq_mark_resolved(retried, dlq.where(F.col("aggregate_id").isNotNull()), NOW, "revisado"))


# ---- commands and log ------------------------------------------------------------------


@registered("validate_commands")
def validate_commands(spark, sf_dir):
    return M.validate_commands(I.commands(spark, sf_dir)).select("command_id", "reject_field", "reject_reason")


@registered("check_item_exists")
def check_item_exists(spark, sf_dir):
    checked = M.check_item_exists(I.commands(spark, sf_dir), I.catalog(spark, sf_dir))
    return _doubles(checked.select("command_id", "anime_id", "item_exists"), "anime_id")


@registered("screen_commands")
def screen_commands(spark, sf_dir):
    return M.screen_commands(I.commands(spark, sf_dir), I.catalog(spark, sf_dir)).select(
        "command_id", "reject_reason", "reject_message")


def _events(spark, sf_dir):
    screened = M.screen_commands(I.commands(spark, sf_dir), I.catalog(spark, sf_dir))
    return materialize(M.commands_to_events(M.accepted(screened)), "events")


@registered("commands_to_events")
def commands_to_events(spark, sf_dir):
    return _doubles(_events(spark, sf_dir), "duration_seconds")


@registered("append_events")
def new_events(spark, sf_dir):
    """The log holds the first part; all commands are sent again, each twice."""
    events = _events(spark, sf_dir)
    resent = events.unionByName(events.withColumn("occurred_at", F.col("occurred_at") + F.expr("INTERVAL 1 SECOND")))
    return L.new_events(_before(events, "occurred_at"), resent).select("event_id", "event_type", "aggregate_id", "occurred_at")


@registered("assign_versions")
def versions(spark, sf_dir):
    """The first part has versions already; the rest continues from them."""
    events = _events(spark, sf_dir)
    earlier = assign_versions(_before(events, "occurred_at"))
    later = assign_versions(_after(events, "occurred_at"), earlier)
    return earlier.unionByName(later).select("event_id", "aggregate_id", "occurred_at", "version")


@registered("ingest_commands")
def event_log(spark, sf_dir):
    return _log(spark, sf_dir).select(
        "event_id", "event_type", "aggregate_id", "event_data", "occurred_at", "version", "metadata")


@registered("ingest_to_log")
def stored_log(spark, sf_dir):
    """The first part, the rest, and all commands again go into one stored log, whose id index is compacted between."""
    path = run_dir(spark, "log")
    commands, catalog = I.commands(spark, sf_dir), I.catalog(spark, sf_dir)
    for part in (_before(commands, "issued_at"), _after(commands, "issued_at"), commands):
        ingest_to_log(spark, part, catalog, path)
        L.compact_index(spark, path)
    return L.read_log(spark, path).select(
        "event_id", "event_type", "aggregate_id", "event_data", "occurred_at", "version", "metadata")


@registered("catch_up_model")
def catch_up_model(spark, sf_dir):
    """The log grows in two parts; after each the stored model is brought up to it."""
    log, model = run_dir(spark, "log"), run_dir(spark, "model")
    commands, catalog = I.commands(spark, sf_dir), I.catalog(spark, sf_dir)
    for part in (_before(commands, "issued_at"), _after(commands, "issued_at")):
        ingest_to_log(spark, part, catalog, log)
        catch_up(spark, log, model, buckets=16)
    return read_model(spark, model).item_stats.select(*R.STATS)


@registered("events_for_aggregate")
def events_for_aggregate(spark, sf_dir):
    """For every aggregate, the later half of its events."""
    log = _log(spark, sf_dir)
    since = log.groupBy("aggregate_id").agg(
        F.call_function("div", F.max("version"), F.lit(2)).alias("from_version"))
    return L.events_for_aggregates(log, since)


@registered("publish_events")
def publish_events(spark, sf_dir):
    return topic.to_messages(_log(spark, sf_dir))


# ---- catalog ---------------------------------------------------------------------------

CLEAN = ["myanimelist_id", "title", "description", "type", "episodes", "released_year", "score", "ranked",
         "members", "characters", "image"]


@registered("clean_catalog")
def clean_catalog(spark, sf_dir):
    return _doubles(C.clean_catalog(I.raw_catalog(spark, sf_dir)).select(*CLEAN), "episodes", "ranked", "members")


@registered("load_catalog")
def load_catalog(spark, sf_dir):
    """The untidy catalog goes through CSV files and into the existing catalog."""
    path = run_dir(spark, "catalog-csv")
    write_catalog_csv(I.raw_catalog(spark, sf_dir), path)
    loaded = catalog_plan.load_catalog(spark, I.catalog(spark, sf_dir), path).catalog
    return _doubles(loaded.select(*CLEAN), "episodes", "ranked", "members")


UPSERTED = ["myanimelist_id", "title", "description", "type", "status", "episodes", "score", "popularity", "members"]


@registered("upsert_catalog")
def upsert_catalog(spark, sf_dir):
    merged = C.upsert_catalog(I.catalog(spark, sf_dir), I.catalog_updates(spark, sf_dir), "load_seq").select(*UPSERTED)
    return _doubles(merged, "episodes", "popularity", "members")


@registered("bucketed_catalog")
def bucketed_catalog(spark, sf_dir):
    """The catalog is stored in buckets, then updated there."""
    root = run_dir(spark, "catalog")
    update_catalog(I.catalog(spark, sf_dir).withColumn("load_seq", F.lit(0)), root, "load_seq", buckets=16)
    update_catalog(I.catalog_updates(spark, sf_dir), root, "load_seq")
    return _doubles(read_catalog(spark, root).select(*UPSERTED), "episodes", "popularity", "members")
