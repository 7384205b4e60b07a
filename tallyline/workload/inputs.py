"""The driver tables as inputs of this domain.

events -> deliveries: every event is delivered twice, the second time with other numbers, so that
a first failure may be followed by a success and a success by a failing copy. The amount decides
which deliveries lack a key, hold a null or are cut off.
events -> commands, part -> catalog, lineitem -> catalog updates.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import events as E

PARTITIONS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread over all cores: the file has one row group, which one task would read and map."""
    return table(spark, sf_dir, "events").repartition(spark.sparkContext.defaultParallelism)


def _facts(events: DataFrame) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("src_id"), "ts", F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("usr"),
        kind.alias("src_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        cents.alias("cents"), F.call_function("div", cents, F.lit(100)).alias("bucket"),
    ).withColumn("item", F.col("k") + 1)


def _pair(key: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{key}":'), text)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def as_deliveries(events: DataFrame) -> DataFrame:
    """Row-local, so the same mapping serves batch and stream."""
    facts = _facts(events).withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1))))
    first, bucket = F.col("attempt") == 0, F.col("bucket")
    kind = (
        F.when(F.col("src_type") == "click", S.CLICK).when(F.col("src_type") == "view", S.VIEW)
        .when(F.col("src_type") == "purchase", S.RATING).otherwise(F.col("src_type"))
    )
    seconds = bucket - F.when(first, 3).otherwise(1)
    rating_cents = F.call_function("div", F.col("cents"), F.when(first, F.lit(10)).otherwise(F.lit(8)))
    rating = F.concat(
        F.call_function("div", rating_cents, F.lit(100)).cast("string"), F.lit("."),
        F.lpad((rating_cents % 100).cast("string"), 2, "0"))
    moment = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    unsigned = (bucket == 40) & first
    pairs = F.concat_ws(
        ",",
        _pair("event_id", _quoted(F.concat(F.lit("evt-"), F.lpad(F.col("src_id").cast("string"), 12, "0")))),
        _pair("event_type", _quoted(kind)),
        F.when(bucket != 33, _pair("aggregate_id", _quoted(E.aggregate_id(F.col("item"))))),
        _pair("anime_id", F.when((bucket == 50) & first, "null").otherwise(F.col("item").cast("string"))),
        F.when(~unsigned, _pair("user_id", _quoted(F.col("usr")))),
        F.when((kind == S.VIEW) & (bucket != 7), _pair("duration_seconds", seconds.cast("string"))),
        F.when((kind == S.RATING) & ~((bucket == 15) & first), _pair("rating", rating)),
        F.when(~unsigned, _pair("occurred_at", _quoted(moment))),
    )
    cut_off = (F.col("src_type") == "error") & (bucket == 60)
    return facts.select(
        E.aggregate_id(F.col("item")).alias("key"),
        F.concat(F.lit("{"), pairs, F.when(cut_off, "").otherwise("}")).alias("value"),
        F.lit(S.TOPIC).alias("topic"), (F.col("k") % PARTITIONS).alias("partition"),
        (F.col("src_id") * 2 + F.col("attempt")).alias("offset"), F.col("ts").alias("timestamp"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_deliveries(events(spark, sf_dir))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(events(spark, sf_dir))
    kind, bucket = F.col("src_type"), F.col("bucket")
    return facts.select(
        F.concat(F.lit("cmd-"), F.col("src_id").cast("string")).alias("command_id"),
        F.when(kind == "purchase", "rating").otherwise(kind).alias("command_type"),
        F.when(bucket != 50, F.col("item")).alias("anime_id"),
        F.when(bucket != 40, F.col("usr")).alias("user_id"),
        F.when(kind == "view", (bucket - 3).cast("int")).alias("duration_seconds"),
        F.when(kind == "purchase", F.call_function("div", F.col("cents"), F.lit(10)) / F.lit(100.0)).alias("rating"),
        F.col("ts").alias("issued_at"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where(F.col("p_size") > 5)
    known = {
        "myanimelist_id": (F.col("p_partkey") + 1).cast("int"), "title": F.col("p_name"),
        "description": F.concat_ws(" ", "p_brand", "p_type"), "type": F.col("p_type"), "episodes": F.col("p_size"),
        "score": F.round(F.pmod(F.col("p_retailprice"), F.lit(10.0)), 1), "popularity": (F.col("p_size") * 1000).cast("int"),
    }
    return part.select(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.CATALOG.fields])


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy text columns as a catalog CSV has them."""
    size, key = F.col("p_size"), F.col("p_partkey")
    body = F.concat(F.lit('{"brand":"'), F.col("p_brand"), F.lit('","size":'), size.cast("string"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.format_number(key + 1, 0)).alias("myanimelist_id"),
        F.when(size == 50, "   ").otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("title"),
        F.concat(F.col("p_brand"), F.lit('\nsays "'), F.col("p_type"), F.lit('"')).alias("description"),
        F.when(size > 40, "").otherwise(F.col("p_type")).alias("Type"),
        F.concat((size - 10).cast("string"), F.lit(".0")).alias("Episodes"),
        F.when(size > 30, "unknown").otherwise(F.concat((size + 1990).cast("string"), F.lit(".0"))).alias("Released_Year"),
        F.when(F.col("p_type") == "SMALL", "N/A").otherwise(F.col("p_retailprice").cast("string")).alias("Score"),
        F.concat(size.cast("string"), F.lit(".0")).alias("Ranked"),
        F.format_number(key * 1000 + 7, 0).alias("Members"),
        F.when(F.col("p_type") == "SMALL", "[]").when(F.col("p_type") == "ECONOMY", body)
        .otherwise(F.concat(body, F.lit("}"))).alias("characters"),
    )


def catalog_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many updates per item, in the order given by `load_seq`; some items are new."""
    known = {
        "myanimelist_id": (F.col("l_partkey") + 1).cast("int"),
        "title": F.concat(F.lit("update "), F.col("l_orderkey").cast("string")),
        "type": F.col("l_returnflag"), "status": F.col("l_linestatus"),
        "episodes": F.when(F.col("l_quantity") > 10, F.col("l_quantity")),
        "score": F.col("l_discount"), "members": F.col("l_suppkey"),
    }
    return table(spark, sf_dir, "lineitem").select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.CATALOG.fields],
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("load_seq"),
    )
