"""Unindexed item documents to messages for the index, and the store after they were taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql.streaming import StreamingQuery

from tallyweave.sources.documents import mark_indexed, pending_index
from tallyweave.sources.messages import INDEX_TOPIC, compose_index_messages, publish_index
from tallyweave.sources.tables import stage


def index_items(
    docs: DataFrame,
    topic: str = INDEX_TOPIC,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    counted: Observation | None = None,
) -> DataFrame:
    """Publish every document that is not indexed yet; returns the store in which they are.

    Messages are sent before the store is said to be indexed: a run that fails in between sends
    them again, and an index takes a message of a known key as the same document.  What is
    sent is written down once, so a store that changes meanwhile gives no half-sent document.
    ``counted`` learns how many documents were read and how many were no JSON and sent nothing.
    """
    taken = stage(pending_index(docs), "index")
    publish_index(compose_index_messages(taken, counted), topic, kafka, path)
    return mark_indexed(docs)


def stream_index(
    doc_stream: DataFrame,
    checkpoint: str,
    topic: str = INDEX_TOPIC,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
) -> StreamingQuery:
    """Publish unindexed documents as they arrive; the checkpoint takes the place of the flag."""
    return publish_index(compose_index_messages(pending_index(doc_stream)), topic, kafka, path, checkpoint)
