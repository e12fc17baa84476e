"""Tables kept in parts, one folder for each value of the part columns.

A run that changes some rows rewrites the parts these rows are in; all other parts keep their
files.  What a part will hold is written down whole before it takes the part's place, so a
run that is cut short loses nothing: ``finish_rewrite`` repeats the last step.
One run at a time may rewrite a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.session import folder_exists, remove_folder

BUCKETS = 64


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    """The part of a row in a table kept by key: rows of one key share it."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_parts(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The table, part columns included in ``layout``; an empty one where nothing was written yet.

    Conditions on part columns choose folders before any file is opened.
    """
    if not folder_exists(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def add_to_parts(rows: DataFrame, path: str, by: list[str]) -> None:
    """Append rows; a large part is written by several tasks, small ones share one."""
    rows.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def rewrite_parts(rows: DataFrame, path: str, by: list[str]) -> None:
    """Put ``rows`` in the place of all parts that they belong to.

    ``rows`` may read the table itself: they are written beside it first.
    """
    rows.write.mode("overwrite").parquet(_beside(path))
    _replace(rows.sparkSession, path, by)


def finish_rewrite(spark: SparkSession, path: str, by: list[str]) -> bool:
    """Repeat the last step of a rewrite that was cut short; says whether there was one.

    Rows that had not been written down whole are dropped, as no part has been touched then.
    """
    beside = _beside(path)
    if folder_exists(spark, f"{beside}/_SUCCESS"):
        _replace(spark, path, by)
        return True
    remove_folder(spark, beside)
    return False


def _beside(path: str) -> str:
    return f"{path.rstrip('/')}.rewrite"


def _replace(spark: SparkSession, path: str, by: list[str]) -> None:
    rows = spark.read.parquet(_beside(path))
    writer = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)
    remove_folder(spark, _beside(path))
