"""The append-once event log: parquet by event date, sorted by aggregate inside the files, an index of its ids in buckets, and
numbered commits that name the folders of both.

Layout under the path: data/run=…/event_date=…, ids/run=…/bucket=…, commits/N.
"""

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions import events as E
from tallyline.operators.versions import number_rows
from tallyline.sources import files

REPLAY_TOPIC = "event_log"
ID_BUCKETS = 64
ATTEMPTS = 20
NO_VERSION = -1
INDEX = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("bucket", T.IntegerType())])


class LogVersion(NamedTuple):
    """The folders that make up the log, and those of its id index, as of commit `number`."""

    number: int
    data: list[str]
    ids: list[str]


def current_version(spark: SparkSession, path: str) -> LogVersion:
    number = files.last_number(spark, f"{path}/commits")
    return LogVersion(number, **json.loads(files.read_number(spark, f"{path}/commits", number)))


def runs_after(spark: SparkSession, path: str, version: LogVersion, number: int) -> LogVersion:
    """What `version` has besides the rows of an earlier commit; all of it for NO_VERSION."""
    if number <= NO_VERSION:
        return version
    earlier = set(json.loads(files.read_number(spark, f"{path}/commits", number))["data"])
    return version._replace(data=[d for d in version.data if d not in earlier])


def read_log(spark: SparkSession, path: str, version: LogVersion | None = None) -> DataFrame:
    """The log as of its last commit, or of an earlier one."""
    version = version or current_version(spark, path)
    return _runs(spark, f"{path}/data", version.data, S.EVENT_LOG)


def _runs(spark: SparkSession, root: str, names: list[str], schema: T.StructType) -> DataFrame:
    """The rows that some runs have written under `root`."""
    with_run = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return spark.read.schema(with_run).option("basePath", root).parquet(*[f"{root}/run={n}" for n in names]).drop("run")


def create_log(spark: SparkSession, path: str) -> None:
    """An empty log; nothing happens to one that is there."""
    if files.last_number(spark, f"{path}/commits") < 0:
        none = spark.createDataFrame([], S.EVENT_LOG).withColumn("event_date", F.lit("1970-01-01").cast("date"))
        none.drop("event_date").write.mode("ignore").parquet(f"{path}/data/run=empty/event_date=1970-01-01")
        files.put_number(spark, f"{path}/commits", 0, json.dumps({"data": ["empty"], "ids": []}))


def log_rows(events: DataFrame, created_at=None) -> DataFrame:
    """Typed events as rows of the log."""
    return events.select(
        "event_id", "event_type", "aggregate_id", E.encode_event().alias("event_data"), "occurred_at",
        "version", "metadata", F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
        F.to_date("occurred_at").alias("event_date"),
    )


def first_copies(batch: DataFrame) -> DataFrame:
    """The row of each event id that occurred first; among rows of one time the smallest by the other columns.

    The time is found by a hash aggregate. Payloads are moved only for ids that came more than once: of these the rows of the first
    time are folded, copies map-side, and one is taken.
    """
    per_id = batch.groupBy(F.col("event_id").alias("_id")).agg(F.min("occurred_at").alias("_first"), F.count("*").alias("_n"))
    again = per_id.where(F.col("_n") > 1).select("_id", "_first")
    own = F.col("event_id") == F.col("_id")
    versions = batch.join(again, own & F.col("occurred_at").eqNullSafe(F.col("_first")), "left_semi").distinct()
    rest = [c for c in batch.columns if c not in ("event_id", "occurred_at")]
    place = F.row_number().over(Window.partitionBy("event_id").orderBy(*rest))
    chosen = versions.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
    return batch.join(again, own, "left_anti").unionByName(chosen)


def new_events(log: DataFrame | None, batch: DataFrame) -> DataFrame:
    """The rows of `batch` the log (or any table of its ids) does not have yet, the first one of each event id.

    The log is first cut down to the ids of the batch: for a small batch that is a broadcast probe of the id column, and the log
    is not shuffled.
    """
    first = first_copies(batch)
    if log is None:
        return first
    known = log.select("event_id").join(batch.select("event_id").distinct(), "event_id", "left_semi")
    return first.join(known, "event_id", "left_anti")


def _bucketed(ids: DataFrame) -> DataFrame:
    return ids.select("event_id", F.pmod(F.xxhash64("event_id"), F.lit(ID_BUCKETS)).cast("int").alias("bucket"))


def known_ids(spark: SparkSession, path: str, version: LogVersion, batch: DataFrame) -> DataFrame:
    """(event_id): the ids of `batch` that the log has, from the buckets of the index that they fall into. The numbers of these
    buckets, at most ID_BUCKETS, come to the driver."""
    ids = _bucketed(batch.where(F.col("event_id").isNotNull())).distinct()
    if not version.ids:
        return ids.select("event_id").where(F.lit(False))
    at_hand = [r.bucket for r in ids.select("bucket").distinct().collect()]
    index = _runs(spark, f"{path}/ids", version.ids, INDEX)
    return ids.join(index.where(F.col("bucket").isin(at_hand)), ["bucket", "event_id"], "left_semi").select("event_id")


def _write_rows(rows: DataFrame, folder: str) -> None:
    """Range partitioning over the whole key spreads a hot day or aggregate over many files and leaves the rows sorted for replay
    by aggregate."""
    key = ["event_date", "aggregate_id", "version", "event_id"]
    (rows.select(*S.EVENT_LOG.fieldNames()).repartitionByRange(*key).sortWithinPartitions(*key)
     .write.partitionBy("event_date").parquet(folder))


def _write_ids(ids: DataFrame, folder: str) -> None:
    (ids.repartition("bucket").sortWithinPartitions("bucket", "event_id").write.partitionBy("bucket").parquet(folder))


def commit_rows(spark: SparkSession, path: str, make: Callable[[LogVersion], DataFrame]) -> DataFrame:
    """Append the rows that `make` gives for a version of the log (its new ids, its next versions); all of them appear or none.

    Rows and their ids are written aside and named by the next commit, a file that is created only if its number is free. If another
    ingest was first, what was written goes, and `make` runs again on the new version: so no event id is there twice and
    versions go on from all that is in the log. Without rows nothing is committed. The rows that were appended.
    """
    create_log(spark, path)
    for _ in range(ATTEMPTS):
        version, name = current_version(spark, path), uuid.uuid4().hex
        data, ids = f"{path}/data/run={name}", f"{path}/ids/run={name}"
        _write_rows(make(version), data)
        written = spark.read.schema(S.EVENT_LOG).parquet(data)
        if not files.names(spark, data):
            files.remove(spark, data)
            return spark.createDataFrame([], S.EVENT_LOG)
        _write_ids(_bucketed(written), ids)
        text = json.dumps({"data": [*version.data, name], "ids": [*version.ids, name]})
        if files.put_number(spark, f"{path}/commits", version.number + 1, text):
            return written
        files.remove(spark, data)
        files.remove(spark, ids)
    raise RuntimeError(f"{ATTEMPTS} other ingests committed first")


def append_events(spark: SparkSession, path: str, events: DataFrame, created_at=None) -> DataFrame:
    """Append the events the log does not have yet; their rows."""
    return commit_rows(spark, path, lambda version: log_rows(
        new_events(known_ids(spark, path, version, events), events), created_at))


def compact_index(spark: SparkSession, path: str) -> None:
    """One folder of the id index in the place of many. An ingest that commits meanwhile makes this one begin again."""
    for _ in range(ATTEMPTS):
        version, name = current_version(spark, path), uuid.uuid4().hex
        if len(version.ids) < 2:
            return
        _write_ids(_runs(spark, f"{path}/ids", version.ids, INDEX), f"{path}/ids/run={name}")
        text = json.dumps({"data": version.data, "ids": [name]})
        if files.put_number(spark, f"{path}/commits", version.number + 1, text):
            return
        files.remove(spark, f"{path}/ids/run={name}")
    raise RuntimeError(f"{ATTEMPTS} other ingests committed first")


def events_for_aggregate(log: DataFrame, aggregate_id: str, from_version: int = 0) -> DataFrame:
    return (
        log.where((F.col("aggregate_id") == aggregate_id) & (F.col("version") > from_version))
        .orderBy("version", "event_id").select("aggregate_id", "version", "event_data")
    )


def events_for_aggregates(log: DataFrame, requests: DataFrame) -> DataFrame:
    """The same for many aggregates: `requests` has aggregate_id and from_version."""
    since = requests.groupBy("aggregate_id").agg(F.min("from_version").alias("from_version"))
    rows = log.select("event_id", "aggregate_id", "version", "event_data")
    return (
        rows.join(since, "aggregate_id")
        .where(F.col("version") > F.col("from_version"))
        .orderBy("aggregate_id", "version", "event_id")
        .select("aggregate_id", "version", "event_data")
    )


def as_deliveries(log: DataFrame) -> DataFrame:
    """The log as deliveries for a replay, in the order (version, occurred_at, event_id) of each aggregate: a
    log whose versions were never assigned, all 1, is replayed by time.

    The offset is the event's place in that order, the partition a hash of the aggregate.
    """
    rows = log.select("aggregate_id", "version", "occurred_at", "event_id", "event_data")
    return number_rows(rows, "aggregate_id", ["version", "occurred_at", "event_id"], "place").select(
        F.col("aggregate_id").alias("key"), F.col("event_data").alias("value"),
        F.lit(REPLAY_TOPIC).alias("topic"),
        F.pmod(F.xxhash64("aggregate_id"), F.lit(1 << E.PARTITION_BITS)).cast("int").alias("partition"),
        F.col("place").alias("offset"), F.col("occurred_at").alias("timestamp"),
    )


def versioned_deliveries(log: DataFrame) -> DataFrame:
    """The same for a log whose versions were assigned: the version is the place, so any part of the log can be replayed after
    the parts before it, and nothing is shuffled."""
    return log.select(
        F.col("aggregate_id").alias("key"), F.col("event_data").alias("value"), F.lit(REPLAY_TOPIC).alias("topic"),
        F.pmod(F.xxhash64("aggregate_id"), F.lit(1 << E.PARTITION_BITS)).cast("int").alias("partition"),
        F.col("version").cast("long").alias("offset"), F.col("occurred_at").alias("timestamp"))
