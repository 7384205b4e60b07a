"""Item catalog: cleaning, upsert, lookups."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import parsing as P

ID = "myanimelist_id"

# CSV header of each catalog column, with its cleaner.
COLUMNS: dict[str, tuple[str, object]] = {
    "myanimelist_id": ("myanimelist_id", P.clean_int),
    "title": ("title", P.clean_text),
    "description": ("description", P.clean_text),
    "image": ("image", P.clean_text),
    "type": ("Type", P.clean_text),
    "episodes": ("Episodes", P.clean_episodes),
    "status": ("Status", P.clean_text),
    "premiered": ("Premiered", P.clean_text),
    "released_season": ("Released_Season", P.clean_text),
    "released_year": ("Released_Year", P.clean_year),
    "source": ("Source", P.clean_text),
    "genres": ("Genres", P.clean_text),
    "themes": ("Themes", P.clean_text),
    "studios": ("Studios", P.clean_text),
    "producers": ("Producers", P.clean_text),
    "demographic": ("Demographic", P.clean_text),
    "duration": ("Duration", P.clean_text),
    "rating": ("Rating", P.clean_text),
    "score": ("Score", P.clean_float),
    "ranked": ("Ranked", P.clean_int),
    "popularity": ("Popularity", P.clean_int),
    "members": ("Members", P.clean_int),
    "favorites": ("Favorites", P.clean_int),
    "characters": ("characters", P.clean_json),
    "source_url": ("source_url", P.clean_text),
}


def clean_catalog(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text columns, named as in the CSV header, to the typed catalog; an absent column is blank.
    `keep` names columns passed through, such as the load order."""

    def source(header: str) -> Column:
        # Header names are matched exactly; "Rating" and "rating" would be different columns.
        return F.col(f"`{header}`") if header in raw.columns else F.lit(None).cast("string")

    return raw.select(*[clean(source(header)).alias(name) for name, (header, clean) in COLUMNS.items()], *keep)


def loadable(clean: DataFrame) -> DataFrame:
    return clean.where(F.col(ID).isNotNull() & F.col("title").isNotNull())


def unloadable(clean: DataFrame) -> DataFrame:
    """Rows without id or title, kept apart instead of stopping the load."""
    return clean.where(F.col(ID).isNull() | F.col("title").isNull())


def latest_rows(rows: DataFrame, order: str) -> DataFrame:
    """The last row of every id by `order`. Ids that come once, which a hash count tells, are passed on unsorted; of the
    others each task keeps its last row before the shuffle."""
    rest = [c for c in rows.columns if c != order]
    counts = rows.groupBy(F.col(ID).alias("_id")).agg(F.count("*").alias("_n"))
    again = counts.where(F.col("_n") > 1).select("_id")
    same = F.col(ID).eqNullSafe(F.col("_id"))
    latest = Window.partitionBy(ID).orderBy(F.desc(order))
    repeated = rows.join(again, same, "left_semi").withColumn("_place", F.row_number().over(latest)).where(F.col("_place") == 1)
    return rows.join(again, same, "left_anti").select(*rest).unionByName(repeated.select(*rest))


def upsert_catalog(old: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """`old` with every id of `new` replaced as a whole, NULLs included; later rows of `new` win."""
    latest = latest_rows(new, order).select(*old.columns)
    return old.join(latest.select(ID), ID, "left_anti").select(*old.columns).unionByName(latest)


def item_for(catalog: DataFrame, anime_id: int) -> DataFrame:
    check_anime_id(anime_id)
    return catalog.where(F.col(ID) == anime_id)


def items_for(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """Catalog rows of the ids in `ids` (column anime_id), each once."""
    wanted = ids.select(F.col("anime_id").alias(ID)).distinct()
    return catalog.join(wanted, ID, "left_semi")


def check_anime_id(anime_id: int) -> None:
    if anime_id < 1:
        raise ValueError("El anime_id debe ser mayor a 0")
