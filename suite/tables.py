"""Table, task and document queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import Tables, query
from tallyweave.operators import tasks, upsert
from tallyweave.operators.recommend import recommendation_tasks
from tallyweave.plans import item_index
from tallyweave.session import shared_folder
from tallyweave.sources import documents, messages
from tallyweave.sources.parts import add_to_parts, bucket_of
from tallyweave.sources.tables import read_table, write_table

LABEL = ["property", "value"]


@query("read_table", "user_filter", "SELECT * FROM user_filter")
def _(t: Tables) -> DataFrame:
    root = shared_folder(t.spark, "tables")
    write_table(t["user_filter"], "user_filter", root)
    return read_table(t.spark, "user_filter", root)


@query(
    "insert_ignore",
    "user_value",
    """SELECT * FROM user_value WHERE rank <= 5
    UNION ALL SELECT property, value, score, rank, 'new-a', 1 FROM user_value WHERE rank > 5""",
)
def _(t: Tables) -> DataFrame:
    labels = t["user_value"]
    twice = labels.withColumn("status", F.explode(F.array(F.lit("new-b"), F.lit("new-a"))))
    return upsert.insert_ignore(labels.where("rank <= 5"), twice, LABEL)


PROPERTY_KEYS = ["property", "userKey", "value"]
_ROWS = "SELECT property, userKey, value FROM user_flat"


_BUMPED = f"""SELECT property, userKey, value, CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 THEN 'ready' ELSE 'pending' END AS status,
       CAST(CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 THEN 5 ELSE 0 END
         + CASE WHEN mod(CAST(userKey AS BIGINT), 3) = 0 THEN 2 ELSE 1 END AS INT) AS revision
    FROM ({_ROWS}) r"""


@query("insert_or_bump_revision", "user_flat", _BUMPED)
def _(t: Tables) -> DataFrame:
    rows = t["user_flat"].select(*PROPERTY_KEYS)
    number = F.col("userKey").cast("bigint")
    target = rows.where(number % 2 == 0).select("*", F.lit("ready").alias("status"), F.lit(5).alias("revision"))
    new = rows.union(rows.where(number % 3 == 0)).withColumn("status", F.lit("pending"))
    return upsert.insert_or_bump_revision(target, new, PROPERTY_KEYS)


# The same target kept in parts: the even users first, then the change.
@query("insert_or_bump_in_parts", "user_flat", _BUMPED)
def _(t: Tables) -> DataFrame:
    rows = t["user_flat"].select(*PROPERTY_KEYS)
    number = F.col("userKey").cast("bigint")
    target = rows.where(number % 2 == 0).select("*", F.lit("ready").alias("status"), F.lit(5).alias("revision"))
    new = rows.union(rows.where(number % 3 == 0)).withColumn("status", F.lit("pending"))
    path = shared_folder(t.spark, "kept-rows")
    add_to_parts(target.withColumn("bucket", bucket_of(PROPERTY_KEYS, 8)), path, ["bucket"])
    upsert.bump_in_parts(t.spark, path, target.schema, new, PROPERTY_KEYS, buckets=8)
    return t.spark.read.schema(target.schema).parquet(path).drop("bucket")


@query(
    "update_from",
    "user_property user_value",
    """SELECT p.property, p.value, p.userKey, p.propertyId,
       CASE WHEN v.property IS NOT NULL THEN v.score ELSE p.score END AS score,
       CASE WHEN v.property IS NOT NULL THEN v.rank ELSE p.rank END AS rank, p.status, p.revision
    FROM user_property p LEFT JOIN (SELECT * FROM user_value WHERE rank > 3) v
      ON v.property = p.property AND v.value = p.value""",
)
def _(t: Tables) -> DataFrame:
    return upsert.update_from(t["user_property"], t["user_value"].where("rank > 3"), LABEL, ["score", "rank"])


for _name, _leaf, _test in (("pending_batch_leaf", True, ">="), ("pending_batch_inner", False, "<")):

    @query(
        _name,
        "user_measure",
        f"""SELECT * FROM user_measure WHERE status = 'pending' AND priority {_test} 900
        ORDER BY priority DESC, userKey, dimension LIMIT 10""",
    )
    def _(t: Tables, leaf: bool = _leaf) -> DataFrame:
        return tasks.pending_batch(t["user_measure"], 10, ["userKey", "dimension"], leaf)


@query(
    "pending_by_status",
    "user_persona",
    "SELECT * FROM user_persona WHERE status = 'pending' ORDER BY userKey, personaId LIMIT 50",
)
def _(t: Tables) -> DataFrame:
    return tasks.pending_by_status(t["user_persona"], "pending", 50, ["userKey", "personaId"])


@query(
    "missing_id_batch_property",
    "item_property",
    "SELECT * FROM item_property WHERE propertyId IS NULL AND categoryId IS NOT NULL",
)
def _(t: Tables) -> DataFrame:
    return tasks.missing_id_batch(t["item_property"], "propertyId", ["categoryId"])


@query("missing_id_batch_category", "item_property", "SELECT * FROM item_property WHERE categoryId IS NULL")
def _(t: Tables) -> DataFrame:
    return tasks.missing_id_batch(t["item_property"], "categoryId")


@query(
    "restart_cycle_idle",
    "idle_measure",
    """SELECT userKey, parent, dimension, weight, score, CASE WHEN priority < 900 THEN 'pending' ELSE status END AS status,
       priority, CASE WHEN priority < 900 THEN revision + 1 ELSE revision END AS revision FROM idle_measure""",
)
def _(t: Tables) -> DataFrame:
    return tasks.restart_cycle(t["idle_measure"], F.col("priority") < 900)


@query("restart_cycle_busy", "user_measure", "SELECT * FROM user_measure")
def _(t: Tables) -> DataFrame:
    return tasks.restart_cycle(t["user_measure"])


@query(
    "mark",
    "user_filter",
    """WITH batch AS (SELECT userKey FROM user_filter WHERE status = 'pending' ORDER BY userKey LIMIT 10)
    SELECT f.userKey, CASE WHEN b.userKey IS NOT NULL THEN 'ready' ELSE f.status END AS status,
       f.revision + CASE WHEN b.userKey IS NOT NULL THEN 1 ELSE 0 END AS revision
    FROM user_filter f LEFT JOIN batch b ON b.userKey = f.userKey""",
)
def _(t: Tables) -> DataFrame:
    batch = tasks.pending_by_status(t["user_filter"], "pending", 10, ["userKey"])
    return tasks.mark(t["user_filter"], batch, ["userKey"], "ready")


# Tables that keep the moments of insertion and change: changed rows get the run's moment, others keep theirs.
_MOMENT, _RUN = "2020-02-02", "2024-03-03"


def dated(rows: DataFrame) -> DataFrame:
    moment = F.lit(_MOMENT).cast("timestamp")
    return rows.withColumns({"createdOn": moment, "modifiedOn": moment})


@query(
    "update_from_dated",
    "user_property user_value",
    f"""SELECT p.property, p.value, p.userKey, p.propertyId, coalesce(v.score, p.score) AS score, coalesce(v.rank, p.rank) AS rank,
       CASE WHEN v.rank IS NOT NULL THEN 'ready' ELSE p.status END AS status, p.revision,
       CAST('{_MOMENT}' AS TIMESTAMP) AS createdOn,
       CAST(CASE WHEN v.rank IS NOT NULL THEN '{_RUN}' ELSE '{_MOMENT}' END AS TIMESTAMP) AS modifiedOn
    FROM user_property p LEFT JOIN (SELECT * FROM user_value WHERE rank > 3) v ON v.property = p.property AND v.value = p.value""",
)
def _(t: Tables) -> DataFrame:
    updates = t["user_value"].where("rank > 3").withColumn("status", F.lit("ready"))
    run = F.lit(_RUN).cast("timestamp")
    return upsert.update_from(dated(t["user_property"]), updates, LABEL, ["score", "rank", "status"], as_of=run)


@query(
    "insert_or_bump_dated",
    "user_flat",
    f"""SELECT *, CAST(CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 THEN '{_MOMENT}' ELSE '{_RUN}' END AS TIMESTAMP) AS createdOn,
       CAST(CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 AND mod(CAST(userKey AS BIGINT), 3) <> 0 THEN '{_MOMENT}' ELSE '{_RUN}' END
         AS TIMESTAMP) AS modifiedOn
    FROM (SELECT property, userKey, value, CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 THEN 'ready' ELSE 'pending' END AS status,
        CAST(CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 0 THEN 5 ELSE 0 END
          + CASE WHEN mod(CAST(userKey AS BIGINT), 2) = 1 OR mod(CAST(userKey AS BIGINT), 3) = 0 THEN 1 ELSE 0 END AS INT) AS revision
      FROM user_flat) r""",
)
def _(t: Tables) -> DataFrame:
    rows = t["user_flat"].select(*PROPERTY_KEYS)
    number = F.col("userKey").cast("bigint")
    target = rows.where(number % 2 == 0).select("*", F.lit("ready").alias("status"), F.lit(5).alias("revision"))
    new = rows.where((number % 2 == 1) | (number % 3 == 0)).withColumn("status", F.lit("pending"))
    return upsert.insert_or_bump_revision(dated(target), new, PROPERTY_KEYS, as_of=F.lit(_RUN).cast("timestamp"))


@query("read_documents", "item_docs", "SELECT * FROM item_docs WHERE status = 'pending'")
def _(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "documents")
    t["item_docs"].write.parquet(path)
    return documents.read_documents(t.spark, path, schema=t["item_docs"].schema)


@query("pending_documents", "item_docs", "SELECT * FROM item_docs WHERE status = 'pending'")
def _(t: Tables) -> DataFrame:
    return documents.pending_documents(t["item_docs"])


@query("mark_taken", "item_docs", "SELECT _key, category, doc, 'ready' AS status, index FROM item_docs")
def _(t: Tables) -> DataFrame:
    return documents.mark_taken(t["item_docs"])


@query("copy_documents", "user_docs", "SELECT _key, doc FROM user_docs")
def _(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "documents")
    documents.copy_documents(t["user_docs"], path)
    return documents.read_documents(t.spark, path, pending_only=False)


@query(
    "pending_index",
    "item_docs",
    "SELECT _key, category, doc, status, 'ready' AS index FROM item_docs WHERE index IS NULL OR index = 'pending'",
)
def _(t: Tables) -> DataFrame:
    return documents.pending_index(t["item_docs"])


# JSON numbers carry no digits beyond their value: 900.0 is written 900
INDEX_MESSAGES = """SELECT _key AS key, '{"_key":"' || _key || '","brand":"' || p_brand || '","price":{"sale":'
       || regexp_replace(CAST(p_retailprice AS STRING), '[.]0$', '') || '},"props":[{"k":"size","v":' || CAST(p_size AS STRING)
       || '}],"tagging":"' || p_name || '","tags":["' || p_type || '","' || p_brand || '"],"title":"' || p_name || '"}' AS value
    FROM item_docs JOIN part ON CAST(p_partkey AS STRING) = _key WHERE index IS NULL OR index = 'pending'"""


@query("compose_index_messages", "item_docs", INDEX_MESSAGES)
def _(t: Tables) -> DataFrame:
    return messages.compose_index_messages(documents.pending_index(t["item_docs"]))


@query("publish_index", "item_docs", INDEX_MESSAGES)
def _(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "messages")
    messages.publish_index(messages.compose_index_messages(documents.pending_index(t["item_docs"])), path=path)
    return t.spark.read.schema("key string, value string").json(f"{path}/{messages.INDEX_TOPIC}")


@query(
    "item_index_documents",
    "item_docs",
    "SELECT * REPLACE (CASE WHEN index IS NULL OR index = 'pending' THEN 'ready' ELSE index END AS index) FROM item_docs",
)
def _(t: Tables) -> DataFrame:
    return item_index.index_items(t["item_docs"], path=shared_folder(t.spark, "messages"))


@query("item_index_messages", "item_docs", INDEX_MESSAGES)
def _(t: Tables) -> DataFrame:
    path = shared_folder(t.spark, "messages")
    # a second run over the store that the first one returns sends nothing
    item_index.index_items(item_index.index_items(t["item_docs"], path=path), path=path)
    return t.spark.read.schema("key string, value string").json(f"{path}/{messages.INDEX_TOPIC}")


for _type, _docs in (("user", "user_docs"), ("persona", "persona_docs")):

    @query(
        f"recommendation_tasks_{_type}",
        _docs,
        f"""SELECT _key AS id, query, '{_type}' AS type, tags,
           CASE WHEN mod(CAST(_key AS BIGINT), 4) = 0 THEN 'ready' ELSE 'pending' END AS status,
           CAST(1 + CASE WHEN mod(CAST(_key AS BIGINT), 4) = 0 THEN 1 ELSE 0 END AS INT) AS revision
        FROM {_docs} WHERE isRecommend IS NULL OR status = 'pending'""",
    )
    def _(t: Tables, type_: str = _type, docs: str = _docs) -> DataFrame:
        store = t[docs]
        known = store.where(F.col("_key").cast("bigint") % 4 == 0).select(
            F.col("_key").alias("id"), "query", F.lit(type_).alias("type"), "tags", F.lit("ready").alias("status"), F.lit(1).alias("revision")
        )
        return recommendation_tasks(known, store, type_)


for _type, _docs in (("user", "user_docs"), ("persona", "persona_docs")):

    @query(
        f"mark_recommended_{_type}",
        _docs,
        f"""SELECT * REPLACE (true AS isRecommend, CASE WHEN isRecommend IS NULL THEN 'ready'
            WHEN status = 'pending' THEN 'ready' ELSE status END AS status) FROM {_docs}""",
    )
    def _(t: Tables, docs: str = _docs) -> DataFrame:
        return documents.mark_recommended(t[docs])
