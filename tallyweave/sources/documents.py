"""Documents: ``_key``, the JSON text ``doc``, and the state flags of the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(
    spark: SparkSession, path: str, pending_only: bool = True, fmt: str = "parquet", schema: str | None = None
) -> DataFrame:
    """Documents of a folder, by default those still pending (the filter reaches the scan)."""
    reader = spark.read.format(fmt)
    docs = (reader.schema(schema) if schema else reader).load(path)
    return pending_documents(docs) if pending_only else docs


def pending_documents(docs: DataFrame) -> DataFrame:
    """The pending documents as they are before they are taken."""
    return docs.where(F.col("status") == "pending")


def mark_taken(docs: DataFrame) -> DataFrame:
    """The store after its pending documents were taken."""
    taken = F.col("status") == "pending"
    return docs.withColumn("status", F.when(taken, F.lit("ready")).otherwise(F.col("status")))


def stream_documents(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """New document files as a stream; the checkpoint takes the place of the pending flag."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def copy_documents(docs: DataFrame, path: str) -> None:
    """Keep the raw documents in the analysis store."""
    docs.select("_key", "doc").write.mode("errorifexists").parquet(path)


def _unindexed() -> Column:
    return F.col("index").isNull() | (F.col("index") == "pending")


def pending_index(docs: DataFrame) -> DataFrame:
    """Documents not indexed yet, as they are after being taken."""
    return docs.where(_unindexed()).withColumn("index", F.lit("ready"))


def mark_indexed(docs: DataFrame) -> DataFrame:
    """The store after its unindexed documents were taken."""
    return docs.withColumn("index", F.when(_unindexed(), F.lit("ready")).otherwise(F.col("index")))


def _unrecommended() -> Column:
    return F.col("isRecommend").isNull() | (F.col("status") == "pending")


def mark_recommended(docs: DataFrame) -> DataFrame:
    """The store after its recommendation tasks were made: what was taken is not taken again."""
    wanted = F.coalesce(_unrecommended(), F.lit(False))
    values = {
        "isRecommend": F.when(wanted, F.lit(True)).otherwise(F.col("isRecommend")),
        "status": F.when(wanted, F.lit("ready")).otherwise(F.col("status")),
    }
    return docs.select(*[values[c].alias(c) if c in values else F.col(c) for c in docs.columns])


def recommendation_rows(docs: DataFrame, type_: str) -> DataFrame:
    """Tasks of documents never recommended or pending again: (id, query, type, tags)."""
    return docs.where(_unrecommended()).select(
        F.col("_key").alias("id"), "query", F.lit(type_).alias("type"), "tags", F.lit("pending").alias("status")
    )
