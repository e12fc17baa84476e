"""Carry the columns of a table through an operator under names of its own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_DEFAULT, _BATCH_TEXTS = "10000", "1000"


def modest_batches(spark: SparkSession) -> None:
    """Send texts to Python a thousand at a time, unless the session has a size of its own.

    Spark's default suits narrow rows; ten thousand texts are held several times over by each task.
    """
    if spark.conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, _BATCH_TEXTS)


def carried(docs: DataFrame, text_col: str, outputs: Iterable[str]) -> tuple[DataFrame, list[str], list[str]]:
    """(columns c0, c1 ... and ``text``), their inner names, their own names.

    Columns that ``outputs`` will replace are left out.  No column of the table can clash with
    what an operator adds on the way.
    """
    modest_batches(docs.sparkSession)
    taken = {name.lower() for name in outputs}
    kept = [c for c in docs.columns if c.lower() not in taken]
    inner = [f"c{i}" for i in range(len(kept))]
    source = docs.select(
        *[F.col(f"`{c}`").alias(i) for c, i in zip(kept, inner)], F.col(f"`{text_col}`").alias("text")
    )
    return source, inner, kept


def restored(inner: list[str], kept: list[str]) -> list[Column]:
    """The carried columns under their own names."""
    return [F.col(i).alias(c) for i, c in zip(inner, kept)]
