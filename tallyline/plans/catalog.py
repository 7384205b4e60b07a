"""Catalog load: CSV to cleaned rows to the next version of the catalog."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyline.operators import catalog as C
from tallyline.sources.catalog_csv import LOAD_ORDER, read_catalog_csv


class CatalogLoad(NamedTuple):
    catalog: DataFrame
    rejected: DataFrame


def load_catalog(spark: SparkSession, old: DataFrame, *paths: str) -> CatalogLoad:
    """The catalog after the load, and the rows that could not be loaded."""
    clean = C.clean_catalog(read_catalog_csv(spark, *paths), keep=(LOAD_ORDER,))
    return CatalogLoad(
        C.upsert_catalog(old, C.loadable(clean), LOAD_ORDER), C.unloadable(clean).drop(LOAD_ORDER))
