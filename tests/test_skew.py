"""Hot keys: the plain joins of the package are split by the planner at run time, without a list of keys."""

from pyspark.sql import functions as F

from helpers import records

SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "40",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
}


def test_every_hot_key_is_spread(spark):
    """Three hot keys and the rows without a key are each worked on by several tasks."""
    key = F.when(F.col("id") % 5 < 3, F.concat(F.lit("hot"), F.col("id") % 5)).when(
        F.col("id") % 5 == 3, F.concat(F.lit("k"), F.col("id")))
    facts = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("row"), key.alias("key"))
    table = spark.createDataFrame([("hot0", 1), ("hot1", 2), ("hot2", 3), ("k3", 4)], "key string, v int")
    saved = {k: spark.conf.get(k) for k in SPLIT}
    try:
        for k, v in SPLIT.items():
            spark.conf.set(k, v)
        joined = facts.join(table, "key", "left")
        parts = joined.select("key", "v", "row", F.spark_partition_id().alias("p"))
        rows = parts.collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    for hot, value in (("hot0", 1), ("hot1", 2), ("hot2", 3), (None, None)):
        own = [r for r in rows if r.key == hot]
        assert len(own) == 8000 and {r.v for r in own} == {value} and len({r.p for r in own}) > 1
    assert records(facts.join(table, "key", "left_semi"), "key").count(("k3",)) == 1
