"""Rows that many more come of are spread over tasks, however few files they are read from."""

import pytest
from pyspark.sql import functions as F

from suite import fixtures, streams
from suite.registry import QUERIES


def shares(df):
    """Rows in each task, the largest first."""
    counted = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted((r["count"] for r in counted), reverse=True)


CUSTOMER = "id AS c_custkey, 'n' AS c_name, CAST(id % 25 AS INT) AS c_nationkey, 1.5D AS c_acctbal, 'BUILDING' AS c_mktsegment"
PART = "id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 'STANDARD' AS p_type, 1 AS p_size, 2.5D AS p_retailprice"


@pytest.mark.parametrize("table, columns, view, times", [
    ("customer", CUSTOMER, "user_persona", 6),
    ("customer", CUSTOMER, "user_evaluation", 11),
    ("customer", CUSTOMER, "user_docs", 1),
    ("part", PART, "item_flat", 7),
    ("part", PART, "item_docs", 1),
])
def test_a_table_in_one_file_is_multiplied_by_many_tasks(spark, tmp_path, table, columns, view, times):
    spark.range(4000).selectExpr(*columns.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    got = shares(fixtures.load(spark, str(tmp_path), view))
    assert sum(got) == 4000 * times
    assert got[0] < sum(got) / 4


def test_the_labels_of_three_runs_are_made_once(spark, rows, tmp_path, monkeypatch):
    varied = PART.replace("'n' AS", "'n' || CAST(id % 30 AS STRING) AS")
    spark.range(90).selectExpr(*varied.split(", ")).write.parquet(f"{tmp_path}/part.parquet")
    seen, arriving = [], streams.arriving

    def watched(t, new, folder):
        seen.append((folder, new.inputFiles()))
        return arriving(t, new, folder)

    monkeypatch.setattr(streams, "arriving", watched)
    found = QUERIES["stream_normalize_item"](spark, str(tmp_path))
    labels = [files for folder, files in seen if "item-labels" in folder]
    assert len(labels) == 3 and all("item-values" in f for files in labels for f in files)
    keys = ["category", "property", "value"]
    ready = fixtures.load(spark, str(tmp_path), "item_value").where("status = 'ready' OR rank IN (3, 5)").select(*keys, "score", "rank")
    whole = fixtures.load(spark, str(tmp_path), "item_property").drop("score", "rank").join(ready, keys)
    columns = [*keys, "itemKey", "score", "rank"]
    assert rows(found, *columns) == rows(whole, *columns) and found.where("status <> 'ready'").isEmpty()
