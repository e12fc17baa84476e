"""Index messages and where they are sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyweave.operators.flatten import parsed_documents

# Fixed value.
INDEX_TOPIC = "stuff"


def compose_index_messages(docs: DataFrame, counted: Observation | str | None = None) -> DataFrame:
    """(key, value): the document as JSON with its key, and its title as tagging where that is missing.

    Documents that are no JSON give no message; ``refused_documents`` lists them and ``counted``
    learns their number, see ``parsed_documents``.
    """
    docs = parsed_documents(docs, ["_key"], "doc", counted)
    fields = F.col("__v").cast("map<string,variant>")
    tagging = F.when(~F.is_variant_null(fields["tagging"]), fields["tagging"])
    own = F.map_filter(fields, lambda k, _: ~k.isin("_key", "tagging"))
    message = F.map_concat(
        own,
        F.create_map(F.lit("_key"), F.col("_key").cast("variant")),
        F.create_map(F.lit("tagging"), F.coalesce(tagging, fields["title"])),
    )
    # parsing the text once more puts the fields in one order
    return docs.select(F.col("_key").alias("key"), F.to_json(F.parse_json(F.to_json(message))).alias("value"))


def publish_index(
    messages: DataFrame,
    topic: str = INDEX_TOPIC,
    kafka: dict[str, str] | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
):
    """Send messages to a Kafka topic, or to JSON files below ``path`` named after the topic.

    A streaming frame starts a query over what is there now and returns it.
    """
    if kafka is None and path is None:
        raise ValueError("name Kafka options or a folder")
    if messages.isStreaming:
        writer = messages.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
        if kafka is not None:
            return writer.format("kafka").options(**kafka).option("topic", topic).start()
        return writer.format("json").start(f"{path}/{topic}")
    if kafka is not None:
        messages.write.format("kafka").options(**kafka).option("topic", topic).save()
    else:
        messages.write.mode("append").json(f"{path}/{topic}")
    return None


def read_messages(values: DataFrame, schema: str) -> DataFrame:
    """Messages back as columns."""
    return values.select("key", F.from_json("value", schema).alias("m")).select("key", "m.*")
