"""The dead-letter table: one row per failed delivery, and its life cycle."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


DEFAULT_LIMIT = 100


def dead_letters(failures: DataFrame) -> DataFrame:
    """New dead letters, failed when they were processed, or else when they arrived. The id is a digest of the
    position, the text and the error, so a retried job writes the same row again."""
    unknown = F.lit("unknown")
    return failures.select(
        F.sha2(F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"),
                           F.sha2("event_data", 256), "error_message"), 256).alias("dlq_id"),
        F.coalesce("event_id", unknown).alias("event_id"),
        F.coalesce("event_type", unknown).alias("event_type"),
        "aggregate_id", "event_data", "error_type", "error_message",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.coalesce("processed_at", "timestamp").alias("failed_at"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp_ntz").alias("last_retry_at"),
        F.lit("failed").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("notes"),
    )


def add_dead_letters(dlq: DataFrame, new: DataFrame) -> DataFrame:
    """New letters added to the table; one that is there, whatever its status, stays as it is."""
    return dlq.unionByName(new.join(dlq.select("dlq_id"), "dlq_id", "left_anti"))


def dlq_list(dlq: DataFrame, status: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The latest failures, of one status or of all; a status that no letter has gives no rows."""
    chosen = dlq.where(F.col("status") == status) if status else dlq
    return chosen.orderBy(F.desc("failed_at"), "dlq_id").limit(limit)


def _touched(dlq: DataFrame, ids: DataFrame) -> DataFrame:
    marked = ids.select("dlq_id").distinct().withColumn("_hit", F.lit(True))
    return dlq.join(marked, "dlq_id", "left")


def _stamp(now: datetime) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def dlq_mark_retry(dlq: DataFrame, ids: DataFrame, now: datetime) -> DataFrame:
    """New version of the table: the given rows, if still failed, wait for a retry. `changed` tells which."""
    hit = F.col("_hit") & (F.col("status") == "failed")
    changed = F.coalesce(hit, F.lit(False))
    return (
        _touched(dlq, ids).withColumn("changed", changed).drop("_hit")
        .withColumn("retry_count", F.col("retry_count") + F.col("changed").cast("int"))
        .withColumn("last_retry_at", F.when(F.col("changed"), _stamp(now)).otherwise(F.col("last_retry_at")))
        .withColumn("status", F.when(F.col("changed"), "retrying").otherwise(F.col("status")))
    )


def dlq_mark_resolved(dlq: DataFrame, ids: DataFrame, now: datetime, notes: str | None = None) -> DataFrame:
    """New version of the table: the given rows are resolved whatever their status; notes stay if none are given."""
    given = F.lit(notes).cast("string")
    return (
        _touched(dlq, ids).withColumn("changed", F.coalesce("_hit", F.lit(False))).drop("_hit")
        .withColumn("resolved_at", F.when(F.col("changed"), _stamp(now)).otherwise(F.col("resolved_at")))
        .withColumn("notes", F.when(F.col("changed"), F.coalesce(given, "notes")).otherwise(F.col("notes")))
        .withColumn("status", F.when(F.col("changed"), "resolved").otherwise(F.col("status")))
    )


# ---- marks kept apart from the letters --------------------------------------------------


def retry_marks(ids: DataFrame, now: datetime) -> DataFrame:
    return _marks(ids, "retry", now, None)


def resolve_marks(ids: DataFrame, now: datetime, notes: str | None = None) -> DataFrame:
    return _marks(ids, "resolve", now, notes)


def _marks(ids: DataFrame, mark: str, now: datetime, notes: str | None) -> DataFrame:
    return ids.select("dlq_id", F.lit(mark).alias("mark"), _stamp(now).alias("marked_at"),
                      F.lit(notes).cast("string").alias("notes")).distinct()


def apply_marks(dlq: DataFrame, marks: DataFrame) -> DataFrame:
    """The letters as their marks leave them, in the order of time: what `dlq_mark_retry` and `dlq_mark_resolved` would have made
    of the table one after another. A retry counts for a failed letter only, so at most the first one does, and none from the
    first resolution on; the last resolution gives the time, the last notes given stay. Marks may be repeated and may come before
    their letter. A retry at the very time of a resolution comes after it.
    """
    retry, resolve = F.col("mark") == "retry", F.col("mark") == "resolve"
    at = F.col("marked_at")
    told = marks.groupBy(F.col("dlq_id").alias("_of")).agg(
        F.min(F.when(retry, at)).alias("_retry"), F.min(F.when(resolve, at)).alias("_first"),
        F.max(F.when(resolve, at)).alias("_last"),
        F.max(F.when(resolve & F.col("notes").isNotNull(), F.struct("marked_at", "notes")))["notes"].alias("_notes"))
    retried = (F.col("status") == "failed") & F.col("_retry").isNotNull() & F.coalesce(F.col("_retry") < F.col("_first"), F.lit(True))
    new = {
        "retry_count": F.col("retry_count") + F.coalesce(retried, F.lit(False)).cast("int"),
        "last_retry_at": F.when(retried, F.col("_retry")).otherwise(F.col("last_retry_at")),
        "status": F.when(F.col("_last").isNotNull(), "resolved").when(retried, "retrying").otherwise(F.col("status")),
        "resolved_at": F.coalesce("_last", "resolved_at"), "notes": F.coalesce("_notes", "notes"),
    }
    joined = dlq.join(told, F.col("dlq_id") == F.col("_of"), "left")
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in dlq.columns])


def changed_count(marked: DataFrame) -> DataFrame:
    """How many rows a marking changed."""
    return marked.agg(F.count(F.when(F.col("changed"), F.lit(1))).alias("changed"))
