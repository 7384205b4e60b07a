"""Commands: field rules, catalog existence, rating rule, and the events accepted commands become."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import events as E
from tallyline.functions.display import float_text

# ---- fixed values: reasons and messages ------------------------------------------------

VALIDATION = "validation"
NOT_FOUND = "AnimeNotFoundError"
INVALID_RATING = "InvalidRatingError"
NEW_VERSION = 1

# Event type of each command type.
EVENT_OF = {"click": S.CLICK, "view": S.VIEW, "rating": S.RATING}

# ----------------------------------------------------------------------------------------


def _not_found_message() -> Column:
    return F.concat(F.lit("Anime con ID "), F.col("anime_id").cast("string"), F.lit(" no existe"))


def _rating_message() -> Column:
    return F.concat(F.lit("Calificación "), float_text(F.col("rating")),
                    F.lit(" no es válida. Debe estar entre 1.0 y 10.0"))


def field_problem() -> Column:
    """The first broken field rule of a command, or NULL."""
    kind = F.col("command_type")
    minutes, rating = F.col("duration_seconds"), F.col("rating")
    return (
        F.when(F.col("command_id").isNull(), "command_id")
        .when(~F.coalesce(kind.isin(*EVENT_OF), F.lit(False)), "command_type")
        .when(F.col("anime_id").isNull(), "anime_id")
        .when(F.col("user_id").isNull(), "user_id")
        .when((kind == "view") & F.coalesce(minutes < 0, F.lit(True)), "duration_seconds")
        .when((kind == "rating") & ~F.coalesce(rating.between(0.0, S.MAX_RATING), F.lit(False)), "rating")
    )


def validate_commands(commands: DataFrame) -> DataFrame:
    """Field rules only: adds `reject_reason` and `reject_field`, NULL for a valid command."""
    return commands.withColumn("reject_field", field_problem()).withColumn(
        "reject_reason", F.when(F.col("reject_field").isNotNull(), VALIDATION))


def check_item_exists(commands: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds `item_exists`. One item may make up a large part of all commands: a plain left join, which broadcasts
    a small catalog and splits large partitions of the commands at run time."""
    known = catalog.select(F.col("myanimelist_id").alias("anime_id")).distinct().withColumn("_known", F.lit(True))
    return (
        commands.join(known, "anime_id", "left").select(*commands.columns, "_known")
        .withColumn("item_exists", F.coalesce("_known", F.lit(False))).drop("_known")
    )


def screen_commands(commands: DataFrame, catalog: DataFrame) -> DataFrame:
    """All checks in their order (fields, existence, rating): adds `reject_reason`, `reject_message`."""
    checked = check_item_exists(commands, catalog)
    problem = field_problem()
    low = (F.col("command_type") == "rating") & (F.col("rating") < S.MIN_RATING)
    return (
        checked.withColumn("_problem", problem)
        .withColumn("reject_reason",
                    F.when(F.col("_problem").isNotNull(), VALIDATION)
                    .when(~F.col("item_exists"), NOT_FOUND)
                    .when(low, INVALID_RATING))
        .withColumn("reject_message",
                    F.when(F.col("reject_reason") == VALIDATION, F.col("_problem"))
                    .when(F.col("reject_reason") == NOT_FOUND, _not_found_message())
                    .when(F.col("reject_reason") == INVALID_RATING, _rating_message()))
        .drop("_problem", "item_exists")
    )


def accepted(screened: DataFrame) -> DataFrame:
    return screened.where(F.col("reject_reason").isNull()).drop("reject_reason", "reject_message")


def refused(screened: DataFrame) -> DataFrame:
    return screened.where(F.col("reject_reason").isNotNull())


def commands_to_events(commands: DataFrame) -> DataFrame:
    """The event envelope of each accepted command."""
    kind = F.lit(None).cast("string")
    for command_type, event_type in EVENT_OF.items():
        kind = F.when(F.col("command_type") == command_type, event_type).otherwise(kind)
    return commands.select(
        E.command_event_id(F.col("command_id")).alias("event_id"),
        kind.alias("event_type"),
        E.aggregate_id(F.col("anime_id")).alias("aggregate_id"),
        F.col("issued_at").alias("occurred_at"),
        F.lit(NEW_VERSION).alias("version"),
        F.lit("{}").alias("metadata"),
        "anime_id", "user_id",
        F.when(F.col("command_type") == "view", F.col("duration_seconds")).alias("duration_seconds"),
        F.when(F.col("command_type") == "rating", F.col("rating")).alias("rating"),
        F.col("issued_at").alias("timestamp"),
    )
