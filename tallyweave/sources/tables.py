"""Relational tables from files or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyweave.schemas import table_schema
from tallyweave.session import shared_folder


def read_table(
    spark: SparkSession,
    name: str,
    root: str | None = None,
    jdbc: dict[str, str] | None = None,
    partition_by: tuple[str, int, int, int] | None = None,
    small: bool = False,
) -> DataFrame:
    """A shared table, with its known layout when read from Parquet below ``root``.

    ``jdbc`` holds Spark's JDBC options (url, driver, user, ...).  Tables are read in
    ranges: ``partition_by`` is (column, lower bound, upper bound, parts).  Only a table
    stated to be ``small`` is read by one task.
    """
    if jdbc is None:
        if root is None:
            raise ValueError("name a folder or JDBC options")
        return spark.read.schema(table_schema(name)).parquet(f"{root}/{name}")
    if partition_by is None and not small:
        raise ValueError("name the ranges to read, or state that the table is small")
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", name)
    if partition_by:
        column, low, high, parts = partition_by
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", parts)
        )
    return reader.load()


def write_table(
    df: DataFrame, name: str, root: str | None = None, jdbc: dict[str, str] | None = None, by: list[str] | None = None
) -> None:
    """Write a new snapshot of a table.

    A snapshot is never written over the files it was computed from: name another
    root for each version.  ``by`` lists partition columns for later pruning.
    """
    if jdbc is not None:
        # a snapshot takes the place of the last one; truncating keeps the table's own layout.  The rows may
        # come from that very table, which is emptied first: so they are written down before
        writer = stage(df, "snapshot").write.format("jdbc").options(**jdbc).option("dbtable", name).option("truncate", "true")
        writer.mode("overwrite").save()
        return
    if root is None:
        raise ValueError("name a folder or JDBC options")
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(f"{root}/{name}")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step of a chain to the shared folder and go on from the files.

    For steps that several later steps read: they are computed once, and a lost
    executor costs no more than the step at hand.  Columns not needed later are not
    read back.  The folder is left to the life cycle of ``spark.checkpoint.dir``.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
