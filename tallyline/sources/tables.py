"""Read-model tables on parquet, read with their explicit schemas."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyline import schemas as S

SCHEMAS = {
    "activity": S.ACTIVITY,
    "item_stats": S.ITEM_STATS,
    "ledger": S.LEDGER,
    "dead_letters": S.DEAD_LETTER,
    "successes": S.SUCCESS,
    "checked": S.CHECKED,
    "catalog": S.CATALOG,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str, partition: str | None = None) -> None:
    """Only the columns of the schema, in its order and types; fails where the table exists."""
    writer = conform(df, SCHEMAS[name]).write
    (writer.partitionBy(partition) if partition else writer).parquet(f"{root}/{name}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
