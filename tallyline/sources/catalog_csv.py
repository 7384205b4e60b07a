"""Catalog CSV: header, quoted fields, line breaks inside quotes. Files are read in byte ranges, however large."""

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.session import materialize

LOAD_ORDER = "load_seq"
QUOTING = {"quote": '"', "escape": '"'}
MARK = "﻿"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, text): the lines of all files under `path`, which Spark reads in byte ranges (`block` is where the range
    begins). A line feed ends a line."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.input_file_block_start().alias("block"),
                       F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): the records of CSV files, numbered from 0 in each file; lines inside quotes belong to one record.

    Whether a line begins a record follows from the number of quotes before it in its file: an even number, as a quote in a quoted field
    is doubled. The ranges are counted apart; the totals of a file's earlier ranges, one row a range, tell each where it stands. So
    no task reads more than its ranges and the lines of the records that begin there. Empty lines between records are left out.
    """
    quotes = F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit('"'), F.lit("")))
    lines = materialize(_lines(spark, path).withColumn("quotes", quotes.cast("long")), "csv-lines")
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, over) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0))

    def placed(rows: DataFrame, column: str, name: str) -> DataFrame:
        """`rows` with the sum of `column` over all earlier lines of the file."""
        totals = rows.groupBy(F.col("file").alias("_file"), F.col("block").alias("_block")).agg(F.sum(column).alias("_total"))
        start = totals.select("_file", "_block", before("_total", earlier).alias("_start"))
        own = rows.withColumn("_own", before(column, inside))
        return own.join(start, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))).select(
            *rows.columns, (F.col("_own") + F.col("_start")).alias(name))

    blank = F.col("text").isin("", "\r", MARK)
    begun = placed(lines, "quotes", "_quotes").select("file", "block", "line", "text", (F.col("_quotes") % 2 == 0).alias("_outside"))
    counted = materialize(begun.where(~(F.col("_outside") & blank)).withColumn("_begins", F.col("_outside").cast("long")), "csv-records")
    numbered = placed(counted, "_begins", "_earlier").select(
        "file", "block", "line", "text", (F.col("_earlier") + F.col("_begins") - 1).alias("record"))
    parts = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "line", "text"))).alias("parts"))
    whole = F.rtrim(F.array_join("parts.text", "\n"), F.lit("\r"))
    return parts.select("file", "record", F.when(F.col("record") == 0, F.ltrim(whole, F.lit(MARK))).otherwise(whole).alias("text"))


def _names(header: str) -> tuple[str, ...]:
    """The names of a header record; a blank one is named by its place."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    return tuple(name or f"_c{i}" for i, name in enumerate(names))


def read_catalog_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """All columns as text, by header name, plus `load_seq`, the order of the rows.

    Each file has its own header, of any length: files may differ in the order and the choice of columns. Files are split into
    byte ranges also where quoted fields hold line breaks. Files follow one another by path, their rows in the order of the text. The
    distinct headers come to the driver.
    """
    whole = None
    for number, path in enumerate(paths):
        stored = materialize(records(spark, path), "csv")
        headers = stored.where("record = 0").select(F.col("file").alias("_of"), F.col("text").alias("_header"))
        for header in sorted(r._header for r in headers.select("_header").distinct().collect()):
            names = _names(header)
            schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
            own = headers.where(F.col("_header") == header)
            rows = stored.where("record > 0").join(own, F.col("file") == F.col("_of"), "left_semi")
            parsed = F.from_csv("text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), QUOTING)
            part = rows.withColumn("_fields", parsed).select(
                *[F.col(f"_fields.c{i}").alias(name) for i, name in enumerate(names)],
                F.struct(F.lit(number).alias("path"), "file", F.col("record").alias("row")).alias(LOAD_ORDER))
            whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole


def write_catalog_csv(raw: DataFrame, path: str) -> None:
    """Raw text columns as CSV in the form `read_catalog_csv` reads."""
    raw.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path)
