"""Small catalogue frames used by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import catalog
from . import fixtures as fx


def fact_items(spark: SparkSession) -> DataFrame:
    """Catalogue of the keyed facts: dataset = return flag."""
    return catalog.catalogue_frame(spark, [(k, v, "1992-01-01", [k], k) for k, v in fx.FACT_ITEM_FREQ])


def event_catalogue(spark: SparkSession) -> DataFrame:
    return catalog.catalogue_frame(spark, [(i, f, d, s, i[:1].upper()) for i, f, d, s in fx.EVENT_CATALOGUE])
