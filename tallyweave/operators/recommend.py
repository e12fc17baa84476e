"""Recommendation task rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyweave.operators.upsert import insert_or_bump_revision
from tallyweave.sources.documents import recommendation_rows


def recommendation_tasks(target: DataFrame, docs: DataFrame, type_: str) -> DataFrame:
    """Put users or personas that need recommendations into the task table."""
    return insert_or_bump_revision(target, recommendation_rows(docs, type_), ["type", "id"])
