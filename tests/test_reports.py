import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import records
from tallyline import schemas as S
from tallyline.functions import display as D
from tallyline.operators import reports as R


def stats(spark, *rows):
    schema = T.StructType([S.ITEM_STATS[c] for c in R.STATS])
    return spark.createDataFrame(list(rows), schema)


def shown(spark, show, *values, kind="bigint"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", show(F.col("v")).alias("s")).orderBy("i").select("s").collect()]


def test_limits(spark):
    for limit in (0, -1, 101):
        for report in (R.top_by_views, R.top_by_rating):
            with pytest.raises(ValueError):
                report(stats(spark), limit)
    assert R.top_by_views(stats(spark), 100).count() == 0


def test_anime_id_is_checked(spark):
    with pytest.raises(ValueError):
        R.stats_for(stats(spark), 0)
    assert R.stats_for(stats(spark, (1, 50, 100, 10, 8.5, 3600)), 1).count() == 1
    assert R.stats_for(stats(spark), 7).count() == 0


def test_shapes(spark):
    got = R.shape_stats(stats(spark, (1, 50, 100, 10, 8.5, 3600), (2, 50, 100, 0, 0.0, 3600), (3, None, None, None, None, None)))
    assert records(got) == [(1, 50, 100, 10, 8.5, 3600), (2, 50, 100, 0, None, 3600), (3, 0, 0, 0, None, 0)]
    item = spark.createDataFrame([(1, "Test Anime", "Test description", "test.jpg", "TV", 12, 8.5, 100),
                                  (2, "b", None, None, None, None, 0.0, None)],
                                 "myanimelist_id int, title string, description string, image string, type string,"
                                 " episodes int, score double, popularity int")
    assert records(R.shape_item(item), "myanimelist_id", "score") == [(1, 8.5), (2, None)]


def test_top_lists(spark):
    table = stats(spark, (1, 0, 5, 4, 9.9, 1), (2, 0, 5, 5, 8.0, 1), (3, 0, 0, 9, 8.0, 1), (4, 0, 7, 0, 0.0, 1))
    assert [r.anime_id for r in R.top_by_views(table).collect()] == [4, 1, 2]
    assert [r.anime_id for r in R.top_by_rating(table).collect()] == [3, 2]
    plan = R.top_by_views(table)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_search_keeps_to_the_hundred_most_viewed(spark):
    table = stats(spark, *[(i, 0, 1000 - i, 0, 0.0, 0) for i in range(1, 151)])
    assert [r.anime_id for r in R.search_items(table, "99").collect()] == [99]
    assert R.search_items(table, "").count() == 100
    assert R.search_items(table, "120").count() == 0


def test_dashboard_totals(spark):
    table = stats(spark, *[(i, 1, 100 - i, 2, 5.0, 400) for i in range(1, 13)])
    assert records(R.dashboard_totals(table)) == [(10, sum(range(90, 100)), 20, 4000, "1h 6m 40s")]
    assert records(R.dashboard_totals(stats(spark))) == [(0, 0, 0, 0, "0s")]


def test_dashboard_table(spark):
    got = R.dashboard_table(stats(spark, (1, 1234, 12345, 1234567, 8.5, 61), (2, 1, 1, 0, 0.0, 5)))
    assert records(got) == [(1, "1234", "12.345", "1.234.567", "8.50", "1m 1s"), (2, "1", "1", "0", "N/A", "5s")]


def test_item_detail_and_top_items(spark):
    catalog = spark.createDataFrame([(1, "a"), (2, "b")], "myanimelist_id int, title string")
    for name, kind in (("description", "string"), ("image", "string"), ("type", "string"), ("episodes", "int"),
                       ("score", "double"), ("popularity", "int")):
        catalog = catalog.withColumn(name, F.lit(None).cast(kind))
    table = stats(spark, (2, 1, 1, 0, 0.0, 0), (3, 1, 2, 0, 0.0, 0))
    assert records(R.item_detail(catalog, table), "anime_id", "title", "total_clicks") == [
        (1, "a", None), (2, "b", 1), (3, None, 1)]
    assert records(R.top_items(R.top_by_views(table), catalog), "anime_id", "title") == [(2, "b"), (3, None)]


def test_texts(spark):
    assert shown(spark, D.format_duration, 0, 59, 60, 3599, 3600, 90061) == ["0s", "59s", "1m 0s", "59m 59s", "1h 0m 0s", "25h 1m 1s"]
    assert shown(spark, D.format_number, 0, 9999, 10000, 1234567) == ["0", "9999", "10.000", "1.234.567"]
    assert shown(spark, D.format_rating, None, 0.0, 8.5, 7.25, kind="double") == ["N/A", "N/A", "8.50", "7.25"]
    values = [11.0, 0.5, 1e7, 12345678.9, 0.0001, 5e-05, 1e16, 1.5e-7, 1e300, float("nan"), float("inf"), float("-inf"), 0.0, -3.25]
    assert shown(spark, D.float_text, *values, kind="double") == [repr(v) for v in values]
