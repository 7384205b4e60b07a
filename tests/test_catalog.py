import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from helpers import records
from tallyline import schemas as S
from tallyline.functions import parsing as P
from tallyline.operators import catalog as C
from tallyline.plans.catalog import load_catalog
from tallyline.sources.catalog_csv import _lines, read_catalog_csv

HEADER = "myanimelist_id,title,description,Type,Episodes,Released_Year,Score,Members,characters"


def cleaned(spark, clean, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", clean(F.col("t")).alias("v")).orderBy("i").select("v").collect()]


def write(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    (folder / "part.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_clean_text(spark):
    assert cleaned(spark, P.clean_text, None, "", "  ", " a b \n", "\t x") == [None, None, None, "a b", "x"]


def test_clean_int(spark):
    assert cleaned(spark, P.clean_int, "2,008,019", " 12 ", "12.0", "x", "", "-3", "3000000000", "1_000", "1 2", "+5") == [
        2008019, 12, None, None, None, -3, None, 1000, None, 5]


def test_clean_float(spark):
    got = cleaned(spark, P.clean_float, "8.5", "1,234", "12d", "1e3", ".5", "5.", "N/A", None, "inf")
    assert got == [8.5, None, None, 1000.0, 0.5, 5.0, None, None, float("inf")]


def test_clean_episodes_and_year(spark):
    assert cleaned(spark, P.clean_episodes, "12.0", "0", "12.9", "nan", "x", "0.5") == [12, None, 12, None, None, 0]
    assert cleaned(spark, P.clean_year, "1998.0", "0", "") == [1998.0, None, None]


def test_clean_json(spark):
    assert cleaned(spark, P.clean_json, '[{"a": 1}]', "[]", "{}", "{bad", "0", '""', "null", "false", " ", "[0]") == [
        '[{"a":1}]', None, None, None, None, None, None, None, None, "[0]"]


def test_csv_with_line_breaks_and_missing_columns(spark, tmp_path):
    path = write(tmp_path, "a", HEADER + '\n1,One,"line ""one""\nline two",TV,12.0,1998.0,8.5,"2,008,019","{""a"": 1}"\n'
                 ' 2 ,Two,  ,,0,0,bad,x,[]\n')
    rows = C.clean_catalog(read_catalog_csv(spark, path))
    assert rows.columns == S.CATALOG.fieldNames()
    assert records(rows, "myanimelist_id", "title", "description", "type", "episodes", "released_year", "score", "members",
                   "characters", "studios") == [
        (1, "One", 'line "one"\nline two', "TV", 12, 1998.0, 8.5, 2008019, '{"a":1}', None),
        (2, "Two", None, None, None, None, None, None, None, None)]


def test_load_replaces_whole_rows_and_the_last_one_wins(spark, tmp_path):
    old = spark.createDataFrame([(1, "Old", 5), (3, "Kept", 6)], "myanimelist_id int, title string, episodes int")
    old = old.select(*[(F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in S.CATALOG.fields])
    one = write(tmp_path, "a", "myanimelist_id,title,Episodes\n1,First,7\n1,Second,\n,No id,1\n4,,1\n2,New,3\n")
    two = write(tmp_path, "b", "title,myanimelist_id\nLater,2\n")
    load = load_catalog(spark, old, one, two)
    assert records(load.catalog, "myanimelist_id", "title", "episodes") == [
        (1, "Second", None), (2, "Later", None), (3, "Kept", 6)]
    assert records(load.rejected, "myanimelist_id", "title") == [(4, None), (None, "No id")]


def test_lookups(spark):
    catalog = spark.createDataFrame([(1, "a"), (2, "b")], "myanimelist_id int, title string")
    assert records(C.item_for(catalog, 2), "title") == [("b",)]
    assert C.item_for(catalog, 99).count() == 0
    ids = spark.createDataFrame([(1,), (1,), (9,)], "anime_id int")
    assert records(C.items_for(catalog, ids), "myanimelist_id") == [(1,)]
    for bad in (0, -1):
        with pytest.raises(ValueError):
            C.item_for(catalog, bad)


def test_files_are_read_by_their_own_header(spark, tmp_path):
    folder = write(tmp_path, "two", "myanimelist_id,title,Members\n1,Alpha,10\n")
    (tmp_path / "two" / "other.csv").write_text('title,"myanimelist_id"\n"Beta, ""b""",2\n', encoding="utf-8")
    got = read_catalog_csv(spark, folder)
    assert records(got, "myanimelist_id", "title", "Members") == [("1", "Alpha", "10"), ("2", 'Beta, "b"', None)]


def test_json_must_be_one_value(spark):
    assert cleaned(spark, P.clean_json, "[1] x", '{"a":1,"a":2}', '{"a":1} {"b":2}', "[1]") == [None, '{"a":2}', None, "[1]"]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    """Quoted line breaks, doubled quotes and CRLF everywhere, cut into byte ranges at every place; more than 100 columns."""
    rng = random.Random(6)
    extra = [f"x{i}" for i in range(150)]
    rows = [[str(i), "".join(rng.choices(["a", "\n", '"', ",", "é", " ", "\r\n", "b c"], k=rng.randrange(12))) + "z", *map(str, range(150))]
            for i in range(400)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\r\n").writerows([["myanimelist_id", "title", *extra], *rows])
    folder = write(tmp_path, "large", "")
    (tmp_path / "large" / "part.csv").write_bytes(out.getvalue().encode())
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4001")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert _lines(spark, folder).rdd.getNumPartitions() > 20
        got = read_catalog_csv(spark, folder).orderBy("load_seq").collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert [[r.myanimelist_id, r.title, r.x0, r.x149] for r in got] == [[r[0], r[1], "0", "149"] for r in rows]
