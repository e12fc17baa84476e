"""Streaming queries: the tables as streams, results read back from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite import fixtures
from suite.registry import Tables, query
from suite.tables import INDEX_MESSAGES
from tallyweave.operators.flatten import flatten_documents
from tallyweave.plans import item_index
from tallyweave.session import shared_folder
from tallyweave.sources import messages
from tallyweave.sources.tables import stage
from tallyweave.streaming import jobs


def stream(t: Tables, base: str, view: str) -> DataFrame:
    """A view over a base table read as a stream; the glob fits a file as well as a folder."""
    schema = t[base].schema
    source = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/{base}.parque[t]")
    return fixtures.over(t.spark, source, base, view)


def _paths(t: Tables, name: str) -> tuple[str, str]:
    root = shared_folder(t.spark, name)
    return f"{root}/rows", f"{root}/checkpoint"


@query("stream_clear_orders", "mod_clearing", "SELECT * FROM mod_clearing")
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "clear")
    jobs.stream_clear_orders(
        stream(t, "orders", "mod_order"),
        t["mod_trace_code"],
        t["mod_broker"],
        t["mod_profit_share_scheme"],
        t["mod_profit_share_item"],
        path,
        checkpoint,
        F.col("order_time"),
    ).awaitTermination()
    return t.spark.read.parquet(path)


@query(
    "stream_flatten",
    "event_docs",
    "SELECT 'k' AS property, CAST(json_extract(doc, '$.k') AS VARCHAR) AS value, _key FROM event_docs",
)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "flatten")
    jobs.stream_flatten(stream(t, "events", "event_docs"), ["_key"], path, checkpoint).awaitTermination()
    return t.spark.read.parquet(path)


# Properties of the users that events belong to: the same value again raises the revision.
@query(
    "stream_property_upsert",
    "",
    """WITH rows AS (SELECT 'k' AS property, CAST(json_extract(props, '$.k') AS VARCHAR) AS value,
         CAST(user_id AS VARCHAR) AS userKey FROM events)
    SELECT property, value, userKey, CAST(count(*) AS INT) AS revision, 'pending' AS status FROM rows
    GROUP BY property, value, userKey""",
)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "upsert")
    keys = ["property", "value", "userKey"]
    docs = stream(t, "events", "user_event_docs")
    jobs.stream_property_upsert(flatten_documents(docs, ["userKey"]), keys, path, checkpoint).awaitTermination()
    return jobs.current_properties(t.spark, keys, path)


# One batch settles all payable rows: nothing earlier, so every voucher is its day's first.
@query(
    "stream_settle",
    "order_payments mod_profit_share_item",
    f"""WITH paid AS (SELECT beneficiary AS broker_id, CAST(CAST(create_date AS DATE) AS VARCHAR) AS day,
         scheme_item_id AS item, amount_profit FROM order_payments WHERE status_clear = 'cleared'),
    sums AS (SELECT broker_id, day || '-' || kinds.beneficiary AS voucher, kinds.beneficiary AS type,
         sum(amount_profit) AS amount
      FROM paid JOIN mod_profit_share_item kinds ON kinds.id = paid.item GROUP BY broker_id, day, kinds.beneficiary)
    SELECT md5(broker_id || '-' || voucher) AS id, broker_id, voucher, type, CAST(amount AS DECIMAL(28,2)) AS amount,
      'settled' AS status, CAST('{fixtures.CUTOFF}' AS TIMESTAMP) AS create_date,
      CAST('{fixtures.CUTOFF}' AS TIMESTAMP) AS update_date FROM sums""",
)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "settle")
    now = F.lit(fixtures.CUTOFF).cast("timestamp")
    jobs.stream_settle(
        stream(t, "orders", "order_payments"), t["mod_profit_share_item"], path, checkpoint, as_of=now
    ).awaitTermination()
    return jobs.earlier_settlements(t.spark, path)


# --- several runs ----------------------------------------------------------------------------------------


def arriving(t: Tables, rows: DataFrame, folder: str) -> DataFrame:
    """Add rows to a folder as new files, and read the folder as a stream."""
    rows.write.mode("append").parquet(folder)
    return t.spark.readStream.schema(rows.schema).parquet(folder)


# The events in three runs, with a merge of the changes after the second one.
@query(
    "stream_property_upsert_runs",
    "",
    """SELECT 'k' AS property, CAST(json_extract(props, '$.k') AS VARCHAR) AS value, CAST(user_id AS VARCHAR) AS userKey,
         CAST(count(*) AS INT) AS revision, 'pending' AS status FROM events GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "upsert-runs")
    keys = ["property", "value", "userKey"]
    folder = shared_folder(t.spark, "events")
    events = t["events"].select(F.col("user_id").cast("string").alias("userKey"), F.col("props").alias("doc"), "event_id")
    for run in range(3):
        docs = arriving(t, events.where(F.col("event_id") % 3 == run), folder)
        jobs.stream_property_upsert(flatten_documents(docs, ["userKey"]), keys, path, checkpoint).awaitTermination()
        if run == 1:
            jobs.compact_properties(t.spark, keys, path, buckets=8)
    return jobs.current_properties(t.spark, keys, path)


# Labels of rank 2 and 4 are there at first, other ready ones come with the second half of the rows, and those
# of rank 3 and 5 become ready after all rows have come.
for _twin, _keys in (("item", ["category", "property", "value"]), ("user", ["property", "value"])):

    @query(
        f"stream_normalize_{_twin}",
        f"{_twin}_property {_twin}_value",
        f"""SELECT p.* REPLACE (v.score AS score, v.rank AS rank, 'ready' AS status)
        FROM {_twin}_property p JOIN {_twin}_value v
          ON {" AND ".join(f"v.{k} = p.{k}" for k in _keys)}
        WHERE v.status = 'ready' OR v.rank IN (3, 5)""",
    )
    def _(t: Tables, twin: str = _twin, keys: list[str] = _keys) -> DataFrame:
        path, checkpoint = _paths(t, "normalize")
        folders = [shared_folder(t.spark, f"{twin}-{what}") for what in ("rows", "labels")]
        # three runs read the labels, which are few, but distinct values of all rows
        rows, labels = t[f"{twin}_property"], stage(t[f"{twin}_value"], f"{twin}-values")
        half = F.crc32(F.col(f"{twin}Key").cast("binary")) % 2
        first = F.col("rank").isin(2, 4) | (F.col("status") == "pending")
        late = labels.where(F.col("rank").isin(3, 5)).withColumn("status", F.lit("ready"))
        for new_rows, new_labels in (
            (rows.where(half == 0), labels.where(first)),
            (rows.where(half == 1), labels.where(~first)),
            (rows.limit(0), late),
        ):
            streams = [arriving(t, new, folder) for new, folder in zip((new_rows, new_labels), folders)]
            jobs.stream_normalize(*streams, keys, path, checkpoint).awaitTermination()
        return t.spark.read.parquet(path)


# Payments come in three files, dated by quarter: a group that is in several files has a voucher for each.
_ARRIVAL = "mod(CAST(amount_profit * 100 AS BIGINT), 3)"


@query(
    "stream_settle_runs",
    "order_payments mod_profit_share_item",
    f"""WITH paid AS (SELECT beneficiary AS broker_id, CAST(CAST(date_trunc('quarter', create_date) AS DATE) AS VARCHAR) AS day,
         scheme_item_id AS item, amount_profit, {_ARRIVAL} AS arrival FROM order_payments WHERE status_clear = 'cleared'),
    sums AS (SELECT broker_id, day, kinds.beneficiary AS type, arrival, sum(amount_profit) AS amount
      FROM paid JOIN mod_profit_share_item kinds ON kinds.id = paid.item GROUP BY broker_id, day, kinds.beneficiary, arrival),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY broker_id, day, type ORDER BY arrival) AS n FROM sums),
    named AS (SELECT *, day || '-' || type || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS voucher FROM numbered)
    SELECT md5(broker_id || '-' || voucher) AS id, broker_id, voucher, type, CAST(amount AS DECIMAL(28,2)) AS amount,
      'settled' AS status, CAST('{fixtures.CUTOFF}' AS TIMESTAMP) AS create_date,
      CAST('{fixtures.CUTOFF}' AS TIMESTAMP) AS update_date FROM named""",
)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "settle-runs")
    now = F.lit(fixtures.CUTOFF).cast("timestamp")
    folder = shared_folder(t.spark, "payments")
    payments = t["order_payments"].withColumn("create_date", F.date_trunc("quarter", "create_date"))
    for run in range(3):
        feed = arriving(t, payments.where(F.expr(_ARRIVAL) == run), folder)
        jobs.stream_settle(feed, t["mod_profit_share_item"], path, checkpoint, as_of=now).awaitTermination()
    return jobs.earlier_settlements(t.spark, path)


@query("stream_index", "item_docs", INDEX_MESSAGES)
def _(t: Tables) -> DataFrame:
    path, checkpoint = _paths(t, "index")
    folder = shared_folder(t.spark, "item-documents")
    for run in range(2):
        half = t["item_docs"].where(F.col("_key").cast("bigint") % 2 == run)
        item_index.stream_index(arriving(t, half, folder), checkpoint, path=path).awaitTermination()
    return t.spark.read.schema("key string, value string").json(f"{path}/{messages.INDEX_TOPIC}")
