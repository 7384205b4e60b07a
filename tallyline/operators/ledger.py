"""The processing ledger and the counts drawn from it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ledger_entries(attempts: DataFrame) -> DataFrame:
    """One row per event id: `success`, or the message of its last failure.

    Type and aggregate come from the delivery that opened the entry. Attempts without an aggregate have no entry, and invalid
    deliveries never reach the ledger. Places and times are found by a hash aggregate, folded map-side; texts stay in their
    rows, and only ids with more than one attempt are looked up.
    """
    ok, named = F.col("ok"), attempts.where(F.col("ledger_aggregate_id").isNotNull())
    per_id = named.groupBy(F.col("event_id").alias("_id")).agg(
        F.count("*").alias("_n"), F.min("ord").alias("_opened"), F.bool_or(ok).alias("_done"),
        F.min_by("processed_at", F.when(ok, F.col("ord"))).alias("_done_at"), F.max_by("processed_at", "ord").alias("_tried_at"),
        F.max(F.when(~ok, F.col("ord"))).alias("_failed"))
    failed = named.where(~ok).select(F.col("event_id").alias("_of"), F.col("ord").alias("_at"), F.col("ledger_message").alias("_message"))
    repeated = per_id.where(F.col("_n") > 1).join(
        failed, (F.col("_id") == F.col("_of")) & (F.col("_failed") == F.col("_at")) & ~F.col("_done"), "left")
    opened = named.join(repeated, F.col("event_id") == F.col("_id"), "left").where(
        F.col("_opened").isNull() | (F.col("ord") == F.col("_opened")))
    done = F.coalesce("_done", ok)
    return opened.select(
        "event_id", "event_type", F.col("ledger_aggregate_id").alias("aggregate_id"),
        F.when(done, "success").otherwise("error").alias("status"),
        F.when(~done, F.coalesce("_message", "ledger_message")).alias("error_message"),
        F.coalesce(F.when(done, F.col("_done_at")).otherwise(F.col("_tried_at")), "processed_at").alias("processed_at"))


def merge_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert by event id: type and aggregate stay as first written; an id once successful stays so, as
    its later deliveries are skipped."""
    known, added = F.col("o.event_id").isNotNull(), F.col("n.event_id").isNotNull()
    stays = known & ((F.col("o.status") == "success") | ~added)

    def kept(column: str, condition: Column) -> Column:
        return F.when(condition, F.col(f"o.{column}")).otherwise(F.col(f"n.{column}")).alias(column)

    return old.alias("o").join(new.alias("n"), F.col("o.event_id") == F.col("n.event_id"), "full").select(
        *[kept(c, known) for c in ("event_id", "event_type", "aggregate_id")],
        *[kept(c, stays) for c in ("status", "error_message", "processed_at")])


def processing_summary(classified: DataFrame) -> DataFrame:
    """Deliveries by type and outcome; skipped duplicates and unknown types count as processed."""
    return with_counter(
        classified.groupBy(F.coalesce("event_type", F.lit("unknown")).alias("event_type"), "outcome")
        .agg(F.count("*").alias("deliveries")))


def with_counter(counts: DataFrame) -> DataFrame:
    return counts.withColumn("counter", F.when(F.col("outcome").isin("error", "invalid"), "error").otherwise("processed"))
