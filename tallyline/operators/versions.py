"""Versions 1, 2, 3… per aggregate, continuing from the log."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialize

def number_rows(rows: DataFrame, key: str, order: list[str], name: str, after: DataFrame | None = None) -> DataFrame:
    """`rows` with their places 1, 2, 3… inside `key` by `order` as column `name`, after the last place that
    `after` (`key`, _last) has.

    A window over the key alone would hand a hot one to one task. The rows are instead cut into ranges of the
    whole sort key, so that a hot key (or a burst at one instant) spans many ranges; numbers inside a range
    get the count of the key's rows in earlier ranges added. The ranges are written once: sampling them again
    could cut them differently.
    """
    ranged = materialize(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), "numbers")

    # Rows here: at most one per range and key.
    counts = ranged.groupBy("_part", F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if after is not None:
        # Only the keys at hand are looked up.
        last = (after.withColumnRenamed(key, "_key").join(counts.select("_key").distinct(), "_key", "left_semi")
                .groupBy("_key").agg(F.max("_last").alias("_last")))
        start = start.join(last, "_key", "left").withColumn(
            "_start", F.col("_start") + F.coalesce("_last", F.lit(0))).drop("_last")

    inside = Window.partitionBy("_part", key).orderBy(*order)
    same = (F.col("r._part") == F.col("s._part")) & F.col(f"r.{key}").eqNullSafe(F.col("s._key"))
    placed = ranged.withColumn("_place", F.row_number().over(inside)).alias("r")
    return placed.join(start.drop("_n").alias("s"), same).select(
        *[F.col(f"r.{c}") for c in rows.columns if c != name], (F.col("_start") + F.col("_place")).alias(name))


def assign_versions(events: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Number the events of each aggregate by (occurred_at, event_id), after the log's last version."""
    last = None if log is None else log.select("aggregate_id", F.col("version").alias("_last"))
    numbered = number_rows(events, "aggregate_id", ["occurred_at", "event_id"], "version", last)
    return numbered.withColumn("version", F.col("version").cast("int")).select(*events.columns)
