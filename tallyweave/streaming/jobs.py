"""Incremental jobs: clearing, flattening, property upserts, normalisation and daily settlement.

Each takes what has arrived since its checkpoint (``availableNow``) and stops.
Checkpoints and outputs belong in a folder all executors share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyweave.operators.flatten import READ, REFUSED, flatten_documents
from tallyweave.operators.money import (
    months_of,
    settle,
    settlement_summary,
    unsettled_groups,
    voucher_month,
    voucher_numbers,
)
from tallyweave.plans.money import clear_pending_orders
from tallyweave.schemas import table_schema
from tallyweave.session import remove_folder
from tallyweave.sources.parts import BUCKETS, bucket_of, finish_rewrite, read_parts, rewrite_parts
from tallyweave.sources.tables import stage


COUNTED = "documents"


def _write(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_clear_orders(
    order_stream: DataFrame,
    trace: DataFrame,
    brokers: DataFrame,
    schemes: DataFrame,
    items: DataFrame,
    path: str,
    checkpoint: str,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Clear orders as they arrive: stream-static joins, append only, no state."""
    return _write(clear_pending_orders(order_stream, trace, brokers, schemes, items, as_of), path, checkpoint)


def stream_flatten(
    doc_stream: DataFrame, key_cols: list[str], path: str, checkpoint: str, doc_col: str = "doc"
) -> StreamingQuery:
    """New documents become property rows; no state.

    The progress of each batch holds how many documents were read and refused (``refusals``).
    """
    return _write(flatten_documents(doc_stream, key_cols, doc_col, COUNTED), path, checkpoint)


def refusals(query: StreamingQuery) -> tuple[int, int]:
    """(documents read, documents refused) by the batches of a flattening stream that are still remembered."""
    seen = [p["observedMetrics"].get(COUNTED) for p in query.recentProgress]
    return sum(s[READ] for s in seen if s), sum(s[REFUSED] for s in seen if s)


def stream_property_upsert(
    flat_stream: DataFrame, keys: list[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Keep a revision per property row: the number of times it has arrived.

    The counts live in the state store, split by key.  Each batch writes only the
    rows it changed, below ``path``/changes in a folder of its own, so a repeated batch
    replaces itself.  ``compact_properties`` merges what has gathered there.
    """
    revisions = flat_stream.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("revision"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")

    return (
        revisions.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _revision_layout(keys: list[str]) -> T.StructType:
    layout = T.StructType()
    for key in keys:
        layout = layout.add(key, "string")
    return layout.add("revision", "integer")


def _changes(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """Rows of the batches not merged yet, with their ``batch_id``."""
    return read_parts(spark, f"{path}/changes", _revision_layout(keys).add("batch_id", "integer"))


def _merged(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """One row per key, kept by ``bucket``."""
    return read_parts(spark, f"{path}/base", _revision_layout(keys).add("bucket", "integer"))


def _latest(changes: DataFrame, keys: list[str]) -> DataFrame:
    return changes.groupBy(*keys).agg(F.max("revision").alias("revision"))


def compact_properties(spark: SparkSession, keys: list[str], path: str, buckets: int = BUCKETS) -> list[int]:
    """Merge the open changes into the base table; returns the buckets that were rewritten.

    Only buckets that hold a changed key are read and rewritten; revisions are
    whole counts, so merging a change twice changes nothing.  ``buckets`` is set by the first
    merge of a table.  Batches written meanwhile stay open.
    """
    finish_rewrite(spark, f"{path}/base", ["bucket"])
    changes = _changes(spark, keys, path)
    batches = [r["batch_id"] for r in changes.select("batch_id").distinct().collect()]
    if not batches:
        return []
    taken = changes.where(F.col("batch_id").isin(batches)).select(*keys, "revision")
    latest = stage(_latest(taken, keys).withColumn("bucket", bucket_of(keys, buckets)), "changes")
    touched = sorted(r["bucket"] for r in latest.select("bucket").distinct().collect())
    old = _merged(spark, keys, path).where(F.col("bucket").isin(touched))
    same = [old[k].eqNullSafe(latest[k]) for k in keys]
    kept = old.join(latest, reduce(Column.__and__, same, old["bucket"] == latest["bucket"]), "left_anti")
    rewrite_parts(kept.unionByName(latest), f"{path}/base", ["bucket"])
    for batch_id in batches:
        remove_folder(spark, f"{path}/changes/batch_id={batch_id}")
    return touched


def current_properties(spark: SparkSession, keys: list[str], path: str) -> DataFrame:
    """The latest revision of each row written by ``stream_property_upsert``.

    The base table passes by but for keys with open changes: nothing that was merged is
    grouped again.
    """
    latest = _latest(_changes(spark, keys, path), keys)
    base = _merged(spark, keys, path).select(*keys, "revision")
    same = reduce(Column.__and__, [base[k].eqNullSafe(latest[k]) for k in keys])
    rows = base.join(latest, same, "left_anti").unionByName(latest)
    return rows.withColumn("status", F.lit("pending"))


def stream_normalize(
    property_stream: DataFrame, label_stream: DataFrame, keys: list[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Property rows with the score and rank of their label, once there is a ready one.

    A row whose label is not ready waits in the state store, however long; a label meets
    all rows before and after it.  ``label_stream`` brings labels anew when their state
    changes; the first ready row of a label counts, as a label's key is unique in its table.
    Every property row is written once, with the rows it arrived with; ``waiting`` tells
    how much waits.  State is split by label key, row by row, so a label of any
    number of rows needs no more memory than another.
    """
    ready = label_stream.where(F.col("status") == "ready").select(*keys, "score", "rank", "status")
    labels = ready.dropDuplicates(keys)
    rows = property_stream.drop("score", "rank", "status")
    found = rows.join(labels, keys)
    return _write(found.select(*[c for c in property_stream.columns]), path, checkpoint)


def state_size(query: StreamingQuery) -> list[dict]:
    """Rows and bytes that each stateful step of a query keeps, from its last progress."""
    progress = query.lastProgress
    steps = (progress or {}).get("stateOperators", [])
    return [
        {"step": s["operatorName"], "rows": s["numRowsTotal"], "bytes": s["memoryUsedBytes"]} for s in steps
    ]


def stream_settle(
    clearing_stream: DataFrame,
    items: DataFrame,
    path: str,
    checkpoint: str,
    settlements: DataFrame | None = None,
    as_of: Column | None = None,
) -> StreamingQuery:
    """Settle payable rows as they arrive, however late; nothing waits and nothing is dropped.

    Each batch keeps its payable rows below ``path``/rows, sums them and numbers their
    vouchers after those of earlier batches and of ``settlements``: a row that comes late
    gets its day's next voucher.  Settlements are kept by month and batch, and a batch looks up its
    own months only, a list no longer than the calendar.  Groups without a kind are kept
    below ``path``/unsettled.  A batch writes to folders of its own, so a repeated batch replaces itself.
    """
    spark = clearing_stream.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        own = f"batch_id={batch_id}"
        payable = (F.col("status_clear") == "cleared") & (F.col("status_settle") == "pending")
        batch.where(payable).write.mode("overwrite").parquet(f"{path}/rows/{own}")
        rows = spark.read.schema(batch.schema).parquet(f"{path}/rows/{own}")
        summary = stage(settlement_summary(rows, items, None), "settlement-groups")
        days = sorted(r["date"] for r in summary.select("date").distinct().collect() if r["date"] is not None)
        known = earlier_settlements(spark, path, batch_id, months_of(days))
        if settlements is not None:
            known = known.unionByName(settlements.where(voucher_month().isin(months_of(days))).select(*known.columns))
        made = settle(voucher_numbers(summary, known), as_of)
        placed = made.withColumns({"month": voucher_month(), "batch_id": F.lit(batch_id)})
        writer = placed.hint("rebalance", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("month", "batch_id").parquet(f"{path}/settlements")
        unsettled_groups(summary).write.mode("overwrite").parquet(f"{path}/unsettled/{own}")

    return (
        clearing_stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def earlier_settlements(
    spark: SparkSession, path: str, batch_id: int | None = None, months: list[str] | None = None
) -> DataFrame:
    """Settlement rows written by ``stream_settle``: of all batches or those before ``batch_id``, of all months or some.

    Batch and month are folders, so others are not opened.
    """
    layout = table_schema("mod_settlement").add("month", "string").add("batch_id", "integer")
    rows = read_parts(spark, f"{path}/settlements", layout)
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") < batch_id)
    if months is not None:
        rows = rows.where(F.col("month").isin(months))
    return rows.drop("month", "batch_id")
