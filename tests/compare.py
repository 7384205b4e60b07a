"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(sql, sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    return normal(columns, got.fetchall())
