"""Per-(item, user) activity and per-item statistics.

All buffers are fixed width (counts, sums, decimals, timestamps picked by a long), so every step is
a hash aggregate with map-side combine: a hot item or pair is folded before anything is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S

KEYS = ["anime_id", "user_id"]


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def clicks_by_item_user(successes: DataFrame) -> DataFrame:
    return (
        successes.where(F.col("event_type") == S.CLICK).groupBy(*KEYS)
        .agg(F.count("*").alias("click_count"), F.max_by("occurred_at", "ord").alias("last_click_at"))
    )


def views_by_item_user(successes: DataFrame) -> DataFrame:
    return (
        successes.where(F.col("event_type") == S.VIEW).groupBy(*KEYS)
        .agg(F.count("*").alias("view_count"),
             F.sum(F.col("duration_seconds").cast("long")).alias("total_duration_seconds"),
             F.max_by("occurred_at", "ord").alias("last_view_at"))
    )


def latest_ratings(successes: DataFrame) -> DataFrame:
    """The rating that arrived last replaces the user's earlier ones."""
    return (
        successes.where(F.col("event_type") == S.RATING).groupBy(*KEYS)
        .agg(F.max_by("rating", "ord").alias("rating"), F.max_by("occurred_at", "ord").alias("rated_at"))
    )


def activity(successes: DataFrame) -> DataFrame:
    """Clicks, views and current rating of every (item, user), in one shuffle."""
    kind = F.col("event_type")
    clicked, viewed, rated = (
        F.when(kind == name, F.col("ord")) for name in (S.CLICK, S.VIEW, S.RATING)
    )
    return successes.groupBy(*KEYS).agg(
        _count_where(kind == S.CLICK).alias("click_count"),
        F.max_by("occurred_at", clicked).alias("last_click_at"),
        F.max(clicked).alias("click_ord"),
        _count_where(kind == S.VIEW).alias("view_count"),
        F.coalesce(F.sum(F.when(kind == S.VIEW, F.col("duration_seconds").cast("long"))), F.lit(0).cast("long"))
        .alias("total_duration_seconds"),
        F.max_by("occurred_at", viewed).alias("last_view_at"),
        F.max(viewed).alias("view_ord"),
        F.max_by("rating", rated).alias("rating"),
        F.max_by("occurred_at", rated).alias("rated_at"),
        F.max(rated).alias("rating_ord"),
        F.max("processed_at").alias("updated_at"),
    )


def merge_activity(*parts: DataFrame) -> DataFrame:
    """Activity tables added up. Associative and commutative, so any split of the events gives the
    same table."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*KEYS).agg(
        F.sum("click_count").alias("click_count"),
        F.max_by("last_click_at", "click_ord").alias("last_click_at"),
        F.max("click_ord").alias("click_ord"),
        F.sum("view_count").alias("view_count"),
        F.sum("total_duration_seconds").alias("total_duration_seconds"),
        F.max_by("last_view_at", "view_ord").alias("last_view_at"),
        F.max("view_ord").alias("view_ord"),
        F.max_by("rating", "rating_ord").alias("rating"),
        F.max_by("rated_at", "rating_ord").alias("rated_at"),
        F.max("rating_ord").alias("rating_ord"),
        F.max("updated_at").alias("updated_at"),
    )


def clicks_table(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("click_count") > 0).select(*KEYS, "click_count", "last_click_at")


def views_table(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("view_count") > 0).select(
        *KEYS, "view_count", "total_duration_seconds", "last_view_at")


def ratings_table(activity: DataFrame) -> DataFrame:
    return activity.where(F.col("rating").isNotNull()).select(*KEYS, "rating", "rated_at")


TOTALS = ["total_clicks", "total_views", "total_ratings", "rating_cents", "total_duration_seconds"]


def item_totals(activity: DataFrame) -> DataFrame:
    """The sums over all users of each touched item. Ratings are the current ones, in cents."""
    return activity.groupBy("anime_id").agg(
        F.sum("click_count").alias("total_clicks"), F.sum("view_count").alias("total_views"),
        F.count("rating").alias("total_ratings"), F.coalesce(F.sum((F.col("rating") * 100).cast("long")), F.lit(0)).alias("rating_cents"),
        F.sum("total_duration_seconds").alias("total_duration_seconds"), F.max("updated_at").alias("updated_at"))


def merge_totals(*parts: DataFrame) -> DataFrame:
    """Totals, and changes of totals, added up."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("anime_id").agg(*[F.sum(c).alias(c) for c in TOTALS], F.max("updated_at").alias("updated_at"))


def totals_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """What totals change by when the activity rows `new` take the place of `old`."""
    gone = item_totals(old).select("anime_id", *[(-F.col(c)).alias(c) for c in TOTALS], "updated_at")
    return merge_totals(gone, item_totals(new))


def item_stats(activity: DataFrame) -> DataFrame:
    """One row per touched item."""
    return stats_of(item_totals(activity))


def stats_of(totals: DataFrame) -> DataFrame:
    """The average is exact, half up, in whole cents; 0 without ratings."""
    n, total = F.col("total_ratings"), F.col("rating_cents")
    half_up = F.call_function("div", total * 2 + n, n * 2) / F.lit(100.0)
    return totals.select("anime_id", "total_clicks", "total_views", "total_ratings",
                         F.when(n > 0, half_up).otherwise(F.lit(0.0)).alias("average_rating"),
                         "total_duration_seconds", "updated_at")
