"""Lookups that complete property rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.upsert import one_row_per_key, update_from


def fill_category_id(property_: DataFrame, categories: DataFrame) -> DataFrame:
    """Category id by category name; rows of unknown categories keep what they have."""
    ids = categories.groupBy(F.col("name").alias("category")).agg(F.max("id").alias("categoryId"))
    return update_from(property_, ids, ["category"], ["categoryId"])


def fill_property_id(property_: DataFrame, measures: DataFrame) -> DataFrame:
    """Measure id by property, within the category where measures have one."""
    keys = ["categoryId", "property"] if "category" in measures.columns else ["property"]
    ids = measures.withColumnRenamed("category", "categoryId").groupBy(*keys).agg(F.max("id").alias("propertyId"))
    return update_from(property_, ids, keys, ["propertyId"])


def normalize(property_: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Score and rank of the labelled value; rows without a ready label stay as they are.

    Of several ready labels of a value the least one counts, so no property row is doubled.
    """
    ready = labels.where(F.col("status") == "ready").select(*keys, "score", "rank", "status")
    return update_from(property_, one_row_per_key(ready, keys), keys, ["score", "rank", "status"])
