"""Text forms used by the dashboard table and in messages."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_duration(seconds: Column) -> Column:
    """`1h 2m 3s`, `2m 3s` or `3s`."""
    s = seconds.cast("long")
    whole_hours = F.call_function("div", s, F.lit(3600))
    whole_minutes = F.call_function("div", s % 3600, F.lit(60))
    hours = F.concat(whole_hours.cast("string"), F.lit("h "))
    minutes = F.concat(whole_minutes.cast("string"), F.lit("m "))
    rest = F.concat((s % 60).cast("string"), F.lit("s"))
    return (
        F.when(whole_hours > 0, F.concat(hours, minutes, rest))
        .when(whole_minutes > 0, F.concat(minutes, rest))
        .otherwise(rest)
    )


def format_number(n: Column) -> Column:
    """Spanish grouping: a dot every three digits, but only from five digits on."""
    return F.when(F.abs(n) < 10000, n.cast("string")).otherwise(
        F.translate(F.format_number(n, 0), ",", ".")
    )


def format_rating(average: Column) -> Column:
    shown = F.nullif(average, F.lit(0.0))
    return F.when(shown.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f", shown))


def float_text(x: Column) -> Column:
    """A double as messages print it: plain from 1e-4 up to 1e16, `1e+16` style beyond."""
    raw = x.cast("string")
    plain = F.regexp_replace(raw.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    short = F.regexp_replace(F.regexp_replace(raw, r"\.0E", "E"), r"E([0-9])", "E+$1")
    scientific = F.lower(F.regexp_replace(short, r"E([+-])([0-9])$", "E$10$2"))
    size = F.abs(x)
    return (
        F.when(F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-4) & (size < 1e16)), plain)
        .otherwise(scientific)
    )
