"""The event topic: Kafka where the connector is on the class path, else a folder of JSON files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S


def to_messages(log: DataFrame) -> DataFrame:
    """One message per event: keyed by aggregate, so one item stays in one partition, in order."""
    return log.select(F.col("aggregate_id").alias("key"), F.col("event_data").alias("value"))


def publish_kafka(messages: DataFrame, servers: str, topic: str = S.TOPIC) -> None:
    (messages.withColumn("topic", F.lit(topic)).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).save())


def publish_files(deliveries: DataFrame, path: str) -> None:
    """Deliveries as JSON lines, for the file form of the topic."""
    deliveries.write.mode("append").json(path)


def read_kafka(spark: SparkSession, servers: str, topic: str = S.TOPIC, per_trigger: int | None = None) -> DataFrame:
    """Stream of deliveries from Kafka, from the earliest offset."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", "earliest")
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


def read_files(spark: SparkSession, path: str, per_trigger: int | None = None, form: str = "json") -> DataFrame:
    """Stream of deliveries from a folder of files."""
    reader = spark.readStream.schema(S.DELIVERY).format(form)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)
