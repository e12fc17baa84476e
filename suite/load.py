"""Flattening, task creation and enrichment queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import ORACLES, Tables, query
from tallyweave.operators import enrich, load
from tallyweave.plans import load as plan
from tallyweave.operators.flatten import flatten_documents, flatten_merge

ITEM_KEYS = ["category", "property", "itemKey", "value"]
USER_KEYS = ["property", "userKey", "value"]


def items(t: Tables) -> DataFrame:
    return t["item_docs"].select(F.col("_key").alias("itemKey"), "category")


def users(t: Tables) -> DataFrame:
    return t["user_docs"].select(F.col("_key").alias("userKey"))


def flat_items(t: Tables) -> DataFrame:
    return flatten_documents(t["item_docs"].withColumnRenamed("_key", "itemKey"), ["category", "itemKey"])


def flat_users(t: Tables) -> DataFrame:
    return flatten_documents(t["user_docs"].withColumnRenamed("_key", "userKey"), ["userKey"])


@query("flatten_documents", "item_flat", "SELECT * FROM item_flat")
def _(t: Tables) -> DataFrame:
    return flat_items(t)


@query(
    "flatten_documents_events",
    "event_docs",
    "SELECT 'k' AS property, CAST(json_extract(doc, '$.k') AS VARCHAR) AS value, _key FROM event_docs",
)
def _(t: Tables) -> DataFrame:
    return flatten_documents(t["event_docs"], ["_key"])


# An event in a document of its own: embedded JSON text, repeated array fields and a null.
@query(
    "flatten_merge",
    "event_docs",
    """WITH n AS (SELECT event_id, _key, CAST(json_extract(doc, '$.k') AS VARCHAR) AS k FROM event_docs
                JOIN events ON CAST(event_id AS VARCHAR) = _key)
    SELECT 'body.k' AS property, k AS value, _key FROM n
    UNION ALL SELECT 'steps.n', CAST(event_id + 1 AS VARCHAR), _key FROM n
    UNION ALL SELECT 'steps.first', CAST(event_id AS VARCHAR), _key FROM n
    UNION ALL SELECT 'none', NULL, _key FROM n""",
)
def _(t: Tables) -> DataFrame:
    n = F.col("_key").cast("bigint")
    doc = F.concat(
        F.lit('{"body":"'),
        F.replace("doc", F.lit('"'), F.lit('\\"')),
        F.lit('","steps":[{"n":'),
        n.cast("string"),
        F.lit(',"first":'),
        n.cast("string"),
        F.lit('},{"n":'),
        (n + 1).cast("string"),
        F.lit('}],"none":null}'),
    )
    return flatten_merge(t["event_docs"].withColumn("doc", doc), ["_key"])


def _target(rows: DataFrame, keys: list[str], key: str) -> DataFrame:
    """A property table that already holds the rows of every third entity."""
    known = rows.where(F.col(key).cast("bigint") % 3 == 0)
    return known.select(*keys, F.lit("ready").alias("status"), F.lit(4).alias("revision"))


for _twin, _key, _keys, _flat in (
    ("item", "itemKey", ITEM_KEYS, flat_items),
    ("user", "userKey", USER_KEYS, flat_users),
):

    @query(
        f"property_rows_{_twin}",
        f"{_twin}_flat",
        f"""SELECT {', '.join(_keys)},
           CASE WHEN mod(CAST({_key} AS BIGINT), 3) = 0 THEN 'ready' ELSE 'pending' END AS status,
           CAST(CASE WHEN mod(CAST({_key} AS BIGINT), 3) = 0 THEN 5 ELSE 1 END AS INT) AS revision
        FROM {_twin}_flat""",
    )
    def _(t: Tables, key=_key, keys=_keys, flat=_flat, twin=_twin) -> DataFrame:
        return load.property_rows(_target(t[f"{twin}_flat"], keys, key), flat(t), keys)

    _label = [k for k in _keys if k != _key]

    @query(
        f"label_candidates_{_twin}",
        f"{_twin}_value {_twin}_flat",
        f"""SELECT {', '.join(_label)}, status, revision FROM {_twin}_value WHERE rank < 4
        UNION ALL SELECT {', '.join(_label)}, 'pending', 1 FROM {_twin}_value WHERE rank >= 4""",
    )
    def _(t: Tables, label=_label, flat=_flat, twin=_twin) -> DataFrame:
        known = t[f"{twin}_value"].where("rank < 4").select(*label, "status", "revision")
        return load.label_candidates(known, flat(t), label)


_ITEMS = "item_docs d JOIN category_tree c ON c.name = d.category"


def _depth(ids: str) -> str:
    return f"CAST(len(string_split(rtrim({ids}, ','), ',')) AS INT)"


_TASK = "'pending' AS status, {} AS priority, 1 AS revision"


@query(
    "measure_tasks_item",
    "item_docs category_tree mod_item_dimension",
    f"""SELECT d._key AS itemKey, m.parent_id AS parent, m.id AS dimension, m.weight, {_TASK.format('400 + ' + _depth('m.parent_ids'))}
    FROM {_ITEMS} JOIN mod_item_dimension m ON m.category = c.id""",
)
def _(t: Tables) -> DataFrame:
    return load.measure_tasks(items(t), t["mod_item_dimension"], "itemKey", t["mod_item_category"])


@query(
    "measure_tasks_user",
    "user_docs mod_user_dimension",
    f"""SELECT d._key AS userKey, m.parent_id AS parent, m.id AS dimension, m.weight, {_TASK.format('400 + ' + _depth('m.parent_ids'))}
    FROM user_docs d CROSS JOIN mod_user_dimension m""",
)
def _(t: Tables) -> DataFrame:
    return load.measure_tasks(users(t), t["mod_user_dimension"], "userKey")


@query(
    "measure_property_tasks_item",
    "item_docs category_tree int_item_dimension_measure",
    f"""SELECT d._key AS itemKey, m.dimension_id AS dimension, m.measure_id AS property, m.weight, {_TASK.format('900')}
    FROM {_ITEMS} JOIN int_item_dimension_measure m ON m.category = c.id""",
)
def _(t: Tables) -> DataFrame:
    return load.measure_property_tasks(items(t), t["int_item_dimension_measure"], "itemKey", t["mod_item_category"])


@query(
    "measure_property_tasks_user",
    "user_docs int_user_dimension_measure",
    f"""SELECT d._key AS userKey, m.dimension_id AS dimension, m.measure_id AS property, m.weight, {_TASK.format('900')}
    FROM user_docs d CROSS JOIN int_user_dimension_measure m""",
)
def _(t: Tables) -> DataFrame:
    return load.measure_property_tasks(users(t), t["int_user_dimension_measure"], "userKey")


@query(
    "promote_measured_item",
    "item_docs category_tree mod_item_dimension int_item_dimension_measure",
    f"""SELECT d._key AS itemKey, m.parent_id AS parent, m.id AS dimension, m.weight, 'pending' AS status,
       CASE WHEN m.id IN (SELECT dimension_id FROM int_item_dimension_measure) THEN 900
            ELSE 400 + {_depth('m.parent_ids')} END AS priority, 1 AS revision
    FROM {_ITEMS} JOIN mod_item_dimension m ON m.category = c.id""",
)
def _(t: Tables) -> DataFrame:
    tasks = load.measure_tasks(items(t), t["mod_item_dimension"], "itemKey", t["mod_item_category"])
    return load.promote_measured(tasks, t["int_item_dimension_measure"])


@query(
    "promote_measured_user",
    "user_docs mod_user_dimension int_user_dimension_measure",
    f"""SELECT d._key AS userKey, m.parent_id AS parent, m.id AS dimension, m.weight, 'pending' AS status,
       CASE WHEN m.id IN (SELECT dimension_id FROM int_user_dimension_measure) THEN 900
            ELSE 400 + {_depth('m.parent_ids')} END AS priority, 1 AS revision
    FROM user_docs d CROSS JOIN mod_user_dimension m""",
)
def _(t: Tables) -> DataFrame:
    tasks = load.measure_tasks(users(t), t["mod_user_dimension"], "userKey")
    return load.promote_measured(tasks, t["int_user_dimension_measure"])


def _base(type_: str, otherwise: str = "0") -> str:
    return (
        f"CASE {type_} WHEN 'perform' THEN 800 WHEN 'cost' THEN 700 WHEN 'constraint' THEN 600 "
        f"WHEN 'satisfy' THEN 500 WHEN 'context' THEN 400 WHEN 'style' THEN 300 ELSE {otherwise} END"
    )


def _eval_rows(twin: str, priority: str) -> str:
    source = (
        f"{_ITEMS} JOIN mod_item_evaluation m ON m.category = c.id"
        if twin == "item"
        else "user_docs d CROSS JOIN mod_user_evaluation m"
    )
    return f"""SELECT d._key AS {twin}Key, m.parent_id AS parent, m.id AS evaluation, m.weight, m.type, m.script, m.category,
       {_TASK.format(f'CAST({priority} AS INT)')} FROM {source}"""


_EVAL_PRIORITY = f"{_base('m.type')} + {_depth('m.parent_ids')}"
_VIEWS = {
    "item": "item_docs category_tree mod_item_evaluation int_item_evaluation_dimension",
    "user": "user_docs mod_user_evaluation int_user_evaluation_dimension",
}


def evaluation_rows(t: Tables, twin: str) -> DataFrame:
    if twin == "item":
        return load.evaluate_tasks(items(t), t["mod_item_evaluation"], "itemKey", t["mod_item_category"])
    return load.evaluate_tasks(users(t), t["mod_user_evaluation"], "userKey")


for _twin in ("item", "user"):

    @query(f"evaluate_tasks_{_twin}", _VIEWS[_twin], _eval_rows(_twin, _EVAL_PRIORITY))
    def _(t: Tables, twin=_twin) -> DataFrame:
        return evaluation_rows(t, twin)

    @query(
        f"promote_evaluated_{_twin}",
        _VIEWS[_twin],
        _eval_rows(
            _twin,
            f"CASE WHEN m.id IN (SELECT evaluation_id FROM int_{_twin}_evaluation_dimension) "
            f"THEN {_base('m.type', '-900')} + 900 ELSE {_EVAL_PRIORITY} END",
        ),
    )
    def _(t: Tables, twin=_twin) -> DataFrame:
        return load.promote_evaluated(
            evaluation_rows(t, twin), t[f"mod_{twin}_evaluation"], t[f"int_{twin}_evaluation_dimension"]
        )


_LEAF = _TASK.format(f"CAST({_base('e.type', '-900')} + 900 AS INT)")


@query(
    "evaluation_measure_tasks_item",
    _VIEWS["item"],
    f"""SELECT d._key AS itemKey, m.evaluation_id AS evaluation, m.dimension_id AS dimension, m.weight, e.type, e.script,
       m.category, {_LEAF}
    FROM {_ITEMS} JOIN int_item_evaluation_dimension m ON m.category = c.id JOIN mod_item_evaluation e ON e.id = m.evaluation_id""",
)
def _(t: Tables) -> DataFrame:
    return load.evaluation_measure_tasks(
        items(t), t["mod_item_evaluation"], t["int_item_evaluation_dimension"], "itemKey", t["mod_item_category"]
    )


@query(
    "evaluation_measure_tasks_user",
    _VIEWS["user"],
    f"""SELECT d._key AS userKey, m.evaluation_id AS evaluation, m.dimension_id AS dimension, m.weight, e.type, e.script, {_LEAF}
    FROM user_docs d CROSS JOIN int_user_evaluation_dimension m JOIN mod_user_evaluation e ON e.id = m.evaluation_id""",
)
def _(t: Tables) -> DataFrame:
    return load.evaluation_measure_tasks(
        users(t), t["mod_user_evaluation"], t["int_user_evaluation_dimension"], "userKey"
    )


@query(
    "query_items",
    "user_docs mod_user_evaluation",
    """SELECT d._key AS userKey, m.category, 'match' AS type,
       CASE WHEN m.type LIKE '%::%' THEN split_part(m.type, '::', 1) ELSE '-' END AS subType,
       CASE WHEN m.type LIKE '%::%' THEN split_part(m.type, '::', 2) ELSE m.type END AS field,
       CAST(NULL AS VARCHAR) AS text, 'pending' AS status, 1 AS revision
    FROM user_docs d CROSS JOIN mod_user_evaluation m""",
)
def _(t: Tables) -> DataFrame:
    return load.query_items(users(t), t["mod_user_evaluation"])


@query(
    "persona_tasks",
    "user_docs mod_persona",
    """SELECT d._key AS userKey, m.hierarchy_id AS hierarchyId, m.phase_id AS phaseId, m.id AS personaId,
       CASE WHEN mod(CAST(d._key AS BIGINT), 2) = 0 AND m.id = 'per1' THEN 'ready' ELSE 'pending' END AS status,
       CAST(CASE WHEN mod(CAST(d._key AS BIGINT), 2) = 0 AND m.id = 'per1' THEN 3 ELSE 1 END AS INT) AS revision
    FROM user_docs d CROSS JOIN mod_persona m""",
)
def _(t: Tables) -> DataFrame:
    known = users(t).where(F.col("userKey").cast("bigint") % 2 == 0).select(
        "userKey",
        F.lit("h1").alias("hierarchyId"),
        F.lit("ph1").alias("phaseId"),
        F.lit("per1").alias("personaId"),
        F.lit("ready").alias("status"),
        F.lit(2).alias("revision"),
    )
    return load.persona_tasks(known, users(t), t["mod_persona"])


@query(
    "filter_tasks",
    "user_docs user_filter",
    """SELECT d._key AS userKey, coalesce(f.status, 'pending') AS status, coalesce(f.revision, 1) AS revision
    FROM user_docs d LEFT JOIN (SELECT * FROM user_filter WHERE status = 'ready') f ON f.userKey = d._key""",
)
def _(t: Tables) -> DataFrame:
    return load.filter_tasks(t["user_filter"].where("status = 'ready'"), users(t))


_BARE = """CAST(NULL AS VARCHAR) AS categoryId, CAST(NULL AS VARCHAR) AS propertyId, CAST(NULL AS DECIMAL(18,6)) AS score,
       CAST(NULL AS INT) AS rank, 'pending' AS status, 1 AS revision"""


def _bare(t: Tables, twin: str) -> DataFrame:
    """Property rows as they are after loading."""
    names = (["categoryId"] if twin == "item" else []) + ["propertyId"]
    return t[f"{twin}_flat"].select(
        "*",
        *[F.lit(None).cast("string").alias(n) for n in names],
        F.lit(None).cast("decimal(18,6)").alias("score"),
        F.lit(None).cast("int").alias("rank"),
        F.lit("pending").alias("status"),
        F.lit(1).alias("revision"),
    )


@query(
    "fill_category_id",
    "item_flat category_tree",
    """SELECT f.property, f.value, f.category, f.itemKey, c.id AS categoryId, CAST(NULL AS VARCHAR) AS propertyId,
       CAST(NULL AS DECIMAL(18,6)) AS score, CAST(NULL AS INT) AS rank, 'pending' AS status, 1 AS revision
    FROM item_flat f LEFT JOIN category_tree c ON c.name = f.category""",
)
def _(t: Tables) -> DataFrame:
    return enrich.fill_category_id(_bare(t, "item"), t["mod_item_category"])


@query(
    "fill_property_id_item",
    "item_property",
    "SELECT property, value, category, itemKey, categoryId, propertyId, score, rank, status, revision FROM item_property",
)
def _(t: Tables) -> DataFrame:
    known = t["item_property"].withColumn("propertyId", F.lit(None).cast("string"))
    return enrich.fill_property_id(known, t["mod_measure"])


@query("fill_property_id_user", "user_property", "SELECT * FROM user_property")
def _(t: Tables) -> DataFrame:
    known = t["user_property"].withColumn("propertyId", F.lit(None).cast("string"))
    return enrich.fill_property_id(known, t["mod_user_measure"])


def _unscored(t: Tables, twin: str) -> DataFrame:
    return t[f"{twin}_property"].select(
        *[
            F.lit(None).cast("decimal(18,6)").alias(c)
            if c == "score"
            else F.lit(None).cast("int").alias(c)
            if c == "rank"
            else F.lit("pending").alias(c)
            if c == "status"
            else F.col(c)
            for c in t[f"{twin}_property"].columns
        ]
    )


@query("normalize_item", "item_property", "SELECT * FROM item_property")
def _(t: Tables) -> DataFrame:
    return enrich.normalize(_unscored(t, "item"), t["item_value"], ["category", "property", "value"])


@query("normalize_user", "user_property", "SELECT * FROM user_property")
def _(t: Tables) -> DataFrame:
    return enrich.normalize(_unscored(t, "user"), t["user_value"], ["property", "value"])


# --- whole loads -----------------------------------------------------------------------------------------

# Every third entity has been loaded before; its rows are ready and stay so.
_LOADS = {
    "measure": "promote_measured_{}",
    "measure_property": "measure_property_tasks_{}",
    "evaluation": "promote_evaluated_{}",
    "evaluation_measure": "evaluation_measure_tasks_{}",
}
_LOAD_CONF = {
    "item": "mod_item_category mod_item_dimension int_item_dimension_measure mod_item_evaluation int_item_evaluation_dimension",
    "user": "mod_user_dimension int_user_dimension_measure mod_user_evaluation int_user_evaluation_dimension mod_persona",
}


def _loaded_before(rows: DataFrame, key: str) -> DataFrame:
    known = rows.where(F.col(key).cast("bigint") % 3 == 0)
    return known.withColumns({"status": F.lit("ready"), "revision": F.lit(7)})


def _kept_sql(name: str, key: str) -> str:
    known = f"mod(CAST({key} AS BIGINT), 3) = 0"
    return f"""SELECT * REPLACE (CASE WHEN {known} THEN 'ready' ELSE status END AS status,
        CASE WHEN {known} THEN 7 ELSE revision END AS revision) FROM ({ORACLES[name]}) made"""


for _twin in ("item", "user"):
    for _task, _source in _LOADS.items():

        @query(f"{_twin}_load_{_task}", "", _kept_sql(_source.format(_twin), f"{_twin}Key"))
        def _(t: Tables, twin=_twin, task=_task) -> DataFrame:
            key, conf = f"{twin}Key", t.some(*_LOAD_CONF[twin].split())
            entities = items(t) if twin == "item" else users(t)
            table = task if twin == "item" else f"user_{task}"
            store = {table: _loaded_before(plan.task_rows(entities, conf, twin)[task], key)}
            return plan.load_entities(entities, t[f"{twin}_flat"], store, conf, twin)[table]


@query("user_load_query", "", _kept_sql("query_items", "userKey"))
def _(t: Tables) -> DataFrame:
    conf = t.some(*_LOAD_CONF["user"].split())
    store = {"user_query": _loaded_before(load.query_items(users(t), conf["mod_user_evaluation"]), "userKey")}
    return plan.load_entities(users(t), t["user_flat"], store, conf, "user")["user_query"]


# Tables without tasks: a known property row is raised by one, known labels, personas and filters stay.
for _twin, _keys in (("item", ITEM_KEYS), ("user", USER_KEYS)):
    _key, _prefix = f"{_twin}Key", "" if _twin == "item" else "user_"

    @query(
        f"{_twin}_load_property",
        f"{_twin}_flat",
        f"""SELECT {', '.join(_keys)}, CASE WHEN mod(CAST({_key} AS BIGINT), 3) = 0 THEN 'ready' ELSE 'pending' END AS status,
           CAST(CASE WHEN mod(CAST({_key} AS BIGINT), 3) = 0 THEN 8 ELSE 1 END AS INT) AS revision
        FROM {_twin}_flat""",
    )
    def _(t: Tables, twin=_twin, keys=_keys, key=_key, prefix=_prefix) -> DataFrame:
        conf, rows = t.some(*_LOAD_CONF[twin].split()), t[f"{twin}_flat"]
        known = _loaded_before(rows.select(*keys), key)
        entities = items(t) if twin == "item" else users(t)
        return plan.load_entities(entities, rows, {f"{prefix}property": known}, conf, twin)[f"{prefix}property"]

    _label = [k for k in _keys if k != _key]

    @query(
        f"{_twin}_load_value",
        f"{_twin}_value",
        f"""SELECT {', '.join(_label)}, CASE WHEN rank < 4 THEN 'ready' ELSE 'pending' END AS status,
           CASE WHEN rank < 4 THEN 7 ELSE 1 END AS revision FROM {_twin}_value""",
    )
    def _(t: Tables, twin=_twin, label=_label, prefix=_prefix) -> DataFrame:
        conf = t.some(*_LOAD_CONF[twin].split())
        known = t[f"{twin}_value"].where("rank < 4").select(*label, F.lit("ready").alias("status"), F.lit(7).alias("revision"))
        entities = items(t) if twin == "item" else users(t)
        return plan.load_entities(entities, t[f"{twin}_flat"], {f"{prefix}value": known}, conf, twin)[f"{prefix}value"]


@query(
    "user_load_persona",
    "user_docs mod_persona",
    """SELECT d._key AS userKey, m.hierarchy_id AS hierarchyId, m.phase_id AS phaseId, m.id AS personaId,
       CASE WHEN mod(CAST(d._key AS BIGINT), 3) = 0 THEN 'ready' ELSE 'pending' END AS status,
       CAST(CASE WHEN mod(CAST(d._key AS BIGINT), 3) = 0 THEN 8 ELSE 1 END AS INT) AS revision
    FROM user_docs d CROSS JOIN mod_persona m""",
)
def _(t: Tables) -> DataFrame:
    conf, none = t.some(*_LOAD_CONF["user"].split()), t["user_persona"].limit(0)
    all_ = load.persona_tasks(none.select(*load.PERSONA_KEYS, "status", "revision"), users(t), conf["mod_persona"])
    store = {"user_persona": _loaded_before(all_, "userKey")}
    return plan.load_entities(users(t), t["user_flat"], store, conf, "user")["user_persona"]


@query(
    "user_load_filter",
    "user_docs user_filter",
    """SELECT d._key AS userKey, coalesce(f.status, 'pending') AS status, coalesce(f.revision, 1) AS revision
    FROM user_docs d LEFT JOIN (SELECT * FROM user_filter WHERE status = 'ready') f ON f.userKey = d._key""",
)
def _(t: Tables) -> DataFrame:
    store = {"user_filter": t["user_filter"].where("status = 'ready'")}
    return plan.load_entities(users(t), t["user_flat"], store, t.some(*_LOAD_CONF["user"].split()), "user")["user_filter"]
