"""Reports over item statistics and the catalog."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import display as D
from tallyline.operators.catalog import check_anime_id

STATS = [c for c in S.ITEM_STATS.fieldNames() if c != "updated_at"]
ITEM = ["myanimelist_id", "title", "description", "image", "type", "episodes", "score", "popularity"]
DASHBOARD_ROWS = 10


def check_limit(limit: int) -> None:
    if limit < 1:
        raise ValueError("El límite debe ser mayor a 0")
    if limit > S.MAX_REPORT_ROWS:
        raise ValueError("El límite no puede ser mayor a 100")


def by_views(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("total_views") > 0).select(*STATS).orderBy(F.desc("total_views"), "anime_id")


def by_rating(stats: DataFrame) -> DataFrame:
    """Best average among items with enough raters."""
    return (
        stats.where((F.col("average_rating") > 0) & (F.col("total_ratings") >= S.MIN_RATERS)).select(*STATS)
        .orderBy(F.desc("average_rating"), F.desc("total_ratings"), "anime_id")
    )


def top_by_views(stats: DataFrame, limit: int = 10) -> DataFrame:
    check_limit(limit)
    return by_views(stats).limit(limit)


def top_by_rating(stats: DataFrame, limit: int = 10) -> DataFrame:
    check_limit(limit)
    return by_rating(stats).limit(limit)


def shape_stats(stats: DataFrame) -> DataFrame:
    """Output form: missing counters are 0, an average of 0 is no average."""
    zero = F.lit(0).cast("long")
    return stats.select(
        "anime_id",
        *[F.coalesce(c, zero).alias(c) for c in ("total_clicks", "total_views", "total_ratings")],
        F.nullif("average_rating", F.lit(0.0)).alias("average_rating"),
        F.coalesce("total_duration_seconds", zero).alias("total_duration_seconds"),
    )


def shape_item(catalog: DataFrame) -> DataFrame:
    return catalog.select(*ITEM).withColumn("score", F.nullif("score", F.lit(0.0)))


def stats_for(stats: DataFrame, anime_id: int) -> DataFrame:
    check_anime_id(anime_id)
    return stats.where(F.col("anime_id") == anime_id)


def stats_for_ids(stats: DataFrame, ids: DataFrame) -> DataFrame:
    """Statistics of the ids in `ids`; an id without statistics gives no row."""
    return stats.join(ids.select("anime_id").distinct(), "anime_id", "left_semi")


def item_detail(catalog: DataFrame, stats: DataFrame) -> DataFrame:
    """Catalog and statistics side by side; either may be missing. Both have one row per item."""
    items = shape_item(catalog).withColumnRenamed("myanimelist_id", "anime_id")
    return items.join(shape_stats(stats), "anime_id", "full_outer")


def top_items(top: DataFrame, catalog: DataFrame) -> DataFrame:
    """A top list of at most MAX_REPORT_ROWS rows, more are refused, with the catalog attributes where there are any.

    The list is worked out once, here. The catalog is only probed: the list is broadcast to it, then the matches
    to the list."""
    rows = top.limit(S.MAX_REPORT_ROWS + 1).collect()
    if len(rows) > S.MAX_REPORT_ROWS:
        raise ValueError(f"a top list has at most {S.MAX_REPORT_ROWS} rows")
    listed = top.sparkSession.createDataFrame(rows, top.schema)
    items = shape_item(catalog).withColumnRenamed("myanimelist_id", "anime_id")
    found = items.join(F.broadcast(listed.select("anime_id")), "anime_id", "left_semi")
    return listed.join(F.broadcast(found), "anime_id", "left")


def search_items(stats: DataFrame, term: str = "") -> DataFrame:
    """Among the 100 most viewed, the items whose id contains the term."""
    return top_by_views(stats, S.MAX_REPORT_ROWS).where(F.col("anime_id").cast("string").contains(term))


def stats_chart_data(stats: DataFrame) -> DataFrame:
    return stats.select("anime_id", "total_views")


def dashboard_totals(stats: DataFrame) -> DataFrame:
    """Sums over the ten most viewed items; zeros when there are none."""

    def total(name: str, alias: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(alias)

    return top_by_views(stats, DASHBOARD_ROWS).agg(
        total("total_clicks", "clicks"), total("total_views", "views"),
        total("total_ratings", "ratings"), total("total_duration_seconds", "duration"),
    ).withColumn("duration_text", D.format_duration(F.col("duration")))


def dashboard_table(top: DataFrame) -> DataFrame:
    """A top list as the dashboard prints it."""
    return shape_stats(top).select(
        "anime_id",
        D.format_number(F.col("total_clicks")).alias("clicks"),
        D.format_number(F.col("total_views")).alias("views"),
        D.format_number(F.col("total_ratings")).alias("ratings"),
        D.format_rating(F.col("average_rating")).alias("average"),
        D.format_duration(F.col("total_duration_seconds")).alias("duration"),
    )
