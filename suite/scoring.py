"""Scoring, evaluation and synchronisation queries, and the whole item chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.load import items, users
from suite.registry import Tables, query
from tallyweave.operators import evaluation as ev
from tallyweave.operators import load, scoring
from tallyweave.operators.profile import entity_profile, profile_rows
from tallyweave.plans import score_changes
from tallyweave.session import shared_folder
from tallyweave.sources.parts import add_to_parts
from tallyweave.plans.user_scoring import scored_users
from tallyweave.plans.item_scoring import scored_documents, scored_items

ITEM_CONF = (
    "mod_item_category mod_measure mod_item_dimension int_item_dimension_measure mod_item_evaluation "
    "int_item_evaluation_dimension mod_motivation mod_occasion"
)
WEIGHTED = {"item": "'a','b','c','d','e','x','y','z'", "user": "'perform','economy','culture','society'"}


# --- oracle pieces: each is a select over named tables ----------------------------------------------------


def leaf_sql(twin: str, measure: str, property_: str) -> str:
    key, mapping = f"{twin}Key", f"int_{twin}_dimension_measure"
    return f"""SELECT t.{key}, t.parent, t.dimension, t.weight,
       CASE WHEN l.dimension_id IS NOT NULL THEN s.total ELSE t.score END AS score,
       CASE WHEN l.dimension_id IS NOT NULL THEN 'ready' ELSE t.status END AS status, t.priority, t.revision
    FROM {measure} t
    LEFT JOIN (SELECT p.{key} AS k, m.dimension_id AS d, CAST(sum(m.weight * p.score) AS DECIMAL(18,6)) AS total
               FROM {property_} p JOIN {mapping} m ON m.measure_id = p.propertyId GROUP BY p.{key}, m.dimension_id) s
      ON s.k = t.{key} AND s.d = t.dimension
    LEFT JOIN (SELECT DISTINCT dimension_id FROM {mapping}) l ON l.dimension_id = t.dimension"""


def closure_sql(tree: str, leaf_ids: str) -> str:
    """(node, ancestor, weight) of the leaves, by climbing at most four levels."""
    inner = f"(SELECT id, parent_id, weight FROM {tree} WHERE id NOT IN (SELECT id FROM ({leaf_ids}) li))"
    level = f"""SELECT n.id AS node, p.id AS ancestor, p.parent_id AS up, CAST(n.weight AS DECIMAL(30,12)) AS weight, p.weight AS own
        FROM {tree} n JOIN {inner} p ON p.id = n.parent_id WHERE n.id IN (SELECT id FROM ({leaf_ids}) lj)"""
    levels = [level]
    for _ in range(3):
        level = f"""SELECT c.node, p.id AS ancestor, p.parent_id AS up, CAST(c.weight * c.own AS DECIMAL(30,12)) AS weight, p.weight AS own
            FROM ({level}) c JOIN {inner} p ON p.id = c.up"""
        levels.append(level)
    return " UNION ALL ".join(f"SELECT node, ancestor, weight FROM ({x}) q{i}" for i, x in enumerate(levels))


def rollup_sql(key: str, rows: str, node: str, tree: str, leaf_ids: str, columns: list[str]) -> str:
    kept = ", ".join(f"t.{c}" for c in columns)
    return f"""SELECT {kept}, CASE WHEN l.id IS NULL THEN s.total ELSE t.score END AS score,
       CASE WHEN l.id IS NULL THEN 'ready' ELSE t.status END AS status
    FROM {rows} t
    LEFT JOIN (SELECT r.{key} AS k, c.ancestor AS a, CAST(sum(CAST(c.weight AS DECIMAL(20,12)) * CAST(r.score AS DECIMAL(18,6))) AS DECIMAL(18,6)) AS total
               FROM {rows} r JOIN ({closure_sql(tree, leaf_ids)}) c ON c.node = r.{node}
               WHERE r.score IS NOT NULL GROUP BY r.{key}, c.ancestor) s ON s.k = t.{key} AND s.a = t.{node}
    LEFT JOIN ({leaf_ids}) l ON l.id = t.{node}"""


def measured_ids(twin: str) -> str:
    return f"SELECT DISTINCT dimension_id AS id FROM int_{twin}_dimension_measure"


def evaluated_ids(twin: str) -> str:
    return f"""SELECT id FROM mod_{twin}_evaluation
        WHERE id NOT IN (SELECT parent_id FROM mod_{twin}_evaluation)
           OR id IN (SELECT evaluation_id FROM int_{twin}_evaluation_dimension)"""


MEASURE_COLUMNS = ["parent", "dimension", "weight", "priority", "revision"]
EVALUATION_COLUMNS = {
    "item": "itemKey parent evaluation weight type script category featured text priority revision".split(),
    "user": "userKey parent evaluation weight type script category persona featured text priority revision".split(),
}


def weighted_sql(twin: str, evaluation: str, measure: str) -> str:
    key = f"{twin}Key"
    kept = ", ".join(f"t.{c}" for c in EVALUATION_COLUMNS[twin])
    return f"""SELECT {kept}, coalesce(s.total, t.score) AS score, CASE WHEN s.total IS NOT NULL THEN 'ready' ELSE t.status END AS status
    FROM {evaluation} t
    LEFT JOIN (SELECT m.{key} AS k, e.id, CAST(sum(x.weight * m.score) AS DECIMAL(18,6)) AS total
               FROM {measure} m JOIN int_{twin}_evaluation_dimension x ON x.dimension_id = m.dimension
               JOIN mod_{twin}_evaluation e ON e.id = x.evaluation_id
               WHERE lower(e.type) IN ({WEIGHTED[twin]}) GROUP BY m.{key}, e.id) s
      ON s.k = t.{key} AND s.id = t.evaluation"""


def _names(owners: str, owner_id: str, csv: str, tags: str) -> str:
    return f"""SELECT o.owner, string_agg(g.name || ' ', '' ORDER BY o.pos) AS text
        FROM (SELECT {owner_id} AS owner, unnest(string_split({csv}, ',')) AS tag,
                     generate_subscripts(string_split({csv}, ','), 1) AS pos FROM {owners}) o
        JOIN {tags} g ON g.id = trim(o.tag) GROUP BY o.owner"""


TAGS = {
    "item": [
        ("'satisfy','satisify'", "category", _names("mod_item_category", "id", "motivation_ids", "mod_motivation")),
        ("'context'", "category", _names("mod_item_category", "id", "occasion_ids", "mod_occasion")),
    ],
    "user": [
        ("'demands'", "persona", _names("mod_life_style", "persona_id", "motivation_ids", "mod_motivation")),
        ("'occasion'", "persona", _names("mod_life_style", "persona_id", "occasion_ids", "mod_occasion")),
    ],
}


def tags_sql(twin: str, evaluation: str) -> str:
    (types1, owner, names1), (types2, _, names2) = TAGS[twin]
    kept = ", ".join(f"t.{c}" for c in EVALUATION_COLUMNS[twin] if c != "text")
    text = f"CASE WHEN lower(t.type) IN ({types1}) THEN a.text WHEN lower(t.type) IN ({types2}) THEN b.text END"
    return f"""SELECT {kept}, t.score, coalesce({text}, t.text) AS text,
       CASE WHEN {text} IS NOT NULL THEN 'ready' ELSE t.status END AS status
    FROM {evaluation} t LEFT JOIN ({names1}) a ON a.owner = t.{owner} LEFT JOIN ({names2}) b ON b.owner = t.{owner}"""


def _one(twin: str, property_: str, name: str, column: str) -> str:
    return f"(SELECT q.{column} FROM {property_} q WHERE q.{twin}Key = t.{twin}Key AND q.property = '{name}')"


def script_sql(twin: str, evaluation: str, property_: str) -> str:
    kept = ", ".join(f"t.{c}" for c in EVALUATION_COLUMNS[twin] if c != "text")
    if twin == "item":
        result = f"""CASE t.type
          WHEN 'constraint' THEN CASE WHEN {_one(twin, property_, 'price.sale', 'score')} > 0.5
               THEN 'high ' || {_one(twin, property_, 'brand', 'value')} ELSE 'low' END
          WHEN 'style' THEN {_one(twin, property_, 'title', 'value')} || '/' || {_one(twin, property_, 'props.0.v', 'value')} END"""
    else:
        result = f"""CASE t.type
          WHEN 'brand::tags' THEN CASE WHEN {_one(twin, property_, 'segment', 'value')} = 'BUILDING' THEN 'builder'
               ELSE lower({_one(twin, property_, 'segment', 'value')}) END
          WHEN 'constraint' THEN CASE WHEN {_one(twin, property_, 'nation', 'value')} = '3'
               THEN {_one(twin, property_, 'name', 'value')} END END"""
    return f"""SELECT {kept}, t.score, coalesce({result}, t.text) AS text,
       CASE WHEN {result} IS NOT NULL THEN 'ready' ELSE t.status END AS status FROM {evaluation} t"""


# --- measures --------------------------------------------------------------------------------------------


def mapping(t: Tables, twin: str) -> DataFrame:
    return t[f"int_{twin}_dimension_measure"].select(
        F.col("dimension_id").alias("dimension"), F.col("measure_id").alias("property"), "weight"
    )


@query(
    "measure_by_property_item",
    "item_measure item_property int_item_dimension_measure",
    leaf_sql("item", "item_measure", "item_property"),
)
def _(t: Tables) -> DataFrame:
    return scoring.measure_by_property(t["item_measure"], mapping(t, "item"), t["item_property"], "itemKey")


# The user query goes through the task rows of each user instead of the configuration.
@query(
    "measure_by_property_user",
    "user_measure user_property int_user_dimension_measure",
    leaf_sql("user", "user_measure", "user_property"),
)
def _(t: Tables) -> DataFrame:
    tasks = load.measure_property_tasks(users(t), t["int_user_dimension_measure"], "userKey")
    return scoring.measure_by_property(t["user_measure"], tasks, t["user_property"], "userKey")


for _twin in ("item", "user"):

    @query(
        f"measure_by_dimension_{_twin}",
        f"{_twin}_measure mod_{_twin}_dimension int_{_twin}_dimension_measure",
        rollup_sql(
            f"{_twin}Key",
            f"{_twin}_measure",
            "dimension",
            f"mod_{_twin}_dimension",
            measured_ids(_twin),
            [f"{_twin}Key", *MEASURE_COLUMNS],
        ),
    )
    def _(t: Tables, twin=_twin) -> DataFrame:
        return scoring.measure_by_dimension(
            t[f"{twin}_measure"], t[f"mod_{twin}_dimension"], t[f"int_{twin}_dimension_measure"], f"{twin}Key"
        )


# Measures are kept by entity and rolled up.  Then the leaves of one entity in a hundred rise by a half, those of
# another have no score any more: what stands above them follows, and the result is as if all had been rolled up.
for _twin in ("item", "user"):

    @query(
        f"measure_by_dimension_delta_{_twin}",
        f"{_twin}_measure mod_{_twin}_dimension int_{_twin}_dimension_measure",
        f"""WITH changed AS (SELECT * REPLACE (
             CASE WHEN mod(CAST({_twin}Key AS BIGINT), 100) = 7 THEN CAST(coalesce(score, 0) + 0.5 AS DECIMAL(18,6))
                  WHEN mod(CAST({_twin}Key AS BIGINT), 100) = 8 THEN NULL ELSE score END AS score,
             CASE WHEN mod(CAST({_twin}Key AS BIGINT), 100) IN (7, 8) THEN 'ready' ELSE status END AS status)
           FROM {_twin}_measure WHERE dimension IN ({measured_ids(_twin)})),
        measures AS (SELECT * FROM changed
           UNION ALL SELECT * FROM {_twin}_measure WHERE dimension NOT IN ({measured_ids(_twin)}))
        {rollup_sql(f"{_twin}Key", "measures", "dimension", f"mod_{_twin}_dimension", measured_ids(_twin), [f"{_twin}Key", *MEASURE_COLUMNS])}""",
    )
    def _(t: Tables, twin=_twin) -> DataFrame:
        key = f"{twin}Key"
        tree, mapping = t[f"mod_{twin}_dimension"], t[f"int_{twin}_dimension_measure"]
        rolled = scoring.measure_by_dimension(t[f"{twin}_measure"], tree, mapping, key)
        path, leaf_ids = shared_folder(t.spark, "measures"), mapping.select("dimension_id")
        add_to_parts(score_changes.by_entity(rolled, key, 32), path, ["bucket"])
        leaves = t[f"{twin}_measure"].join(leaf_ids.distinct().toDF("dimension"), "dimension", "left_semi")
        number = F.col(key).cast("bigint") % 100
        score = F.when(number == 7, F.coalesce("score", F.lit(0)) + F.lit("0.5").cast("decimal(2,1)"))
        changes = leaves.where(number.isin(7, 8)).select(key, "dimension", score.cast("decimal(18,6)").alias("score"))
        score_changes.change_scores(t.spark, path, rolled.schema, changes, "dimension", key, tree, leaf_ids, 32)
        return t.spark.read.schema(rolled.schema).parquet(path).drop("bucket")


# --- evaluations -----------------------------------------------------------------------------------------


def evaluation_mapping(t: Tables, twin: str) -> DataFrame:
    return load.evaluation_mapping(t[f"mod_{twin}_evaluation"], t[f"int_{twin}_evaluation_dimension"]).select(
        F.col("evaluation_id").alias("evaluation"), "type", F.col("dimension_id").alias("dimension"), "weight"
    )


_EVAL_VIEWS = "{0}_evaluation {0}_measure mod_{0}_evaluation int_{0}_evaluation_dimension"


@query(
    "evaluate_weighted_item",
    _EVAL_VIEWS.format("item"),
    weighted_sql("item", "item_evaluation", "item_measure"),
)
def _(t: Tables) -> DataFrame:
    return scoring.evaluate_weighted(
        t["item_evaluation"], evaluation_mapping(t, "item"), t["item_measure"], "itemKey", scoring.WEIGHTED_TYPES["item"]
    )


@query(
    "evaluate_weighted_user",
    _EVAL_VIEWS.format("user"),
    weighted_sql("user", "user_evaluation", "user_measure"),
)
def _(t: Tables) -> DataFrame:
    tasks = load.evaluation_measure_tasks(
        users(t), t["mod_user_evaluation"], t["int_user_evaluation_dimension"], "userKey"
    )
    return scoring.evaluate_weighted(
        t["user_evaluation"], tasks, t["user_measure"], "userKey", scoring.WEIGHTED_TYPES["user"]
    )


def evaluation_leaves(t: Tables, twin: str) -> DataFrame:
    evals = t[f"mod_{twin}_evaluation"]
    childless = evals.join(evals.select(F.col("parent_id").alias("id")).distinct(), "id", "left_anti").select("id")
    return childless.union(t[f"int_{twin}_evaluation_dimension"].select("evaluation_id")).distinct()


for _twin in ("item", "user"):

    @query(
        f"evaluate_by_dimension_{_twin}",
        _EVAL_VIEWS.format(_twin),
        rollup_sql(
            f"{_twin}Key",
            f"{_twin}_evaluation",
            "evaluation",
            f"mod_{_twin}_evaluation",
            evaluated_ids(_twin),
            EVALUATION_COLUMNS[_twin],
        ),
    )
    def _(t: Tables, twin=_twin) -> DataFrame:
        return scoring.evaluate_by_dimension(
            t[f"{twin}_evaluation"], t[f"mod_{twin}_evaluation"], evaluation_leaves(t, twin), f"{twin}Key"
        )


@query(
    "evaluate_tags_item",
    "item_evaluation mod_item_category mod_motivation mod_occasion",
    tags_sql("item", "item_evaluation"),
)
def _(t: Tables) -> DataFrame:
    owners = t["mod_item_category"]
    rows = ev.evaluate_tags(
        t["item_evaluation"],
        ["satisfy", "satisify"],
        "category",
        ev.tag_texts(owners, "id", "motivation_ids", t["mod_motivation"]),
    )
    return ev.evaluate_tags(rows, ["context"], "category", ev.tag_texts(owners, "id", "occasion_ids", t["mod_occasion"]))


@query(
    "evaluate_tags_user",
    "user_evaluation mod_life_style mod_motivation mod_occasion",
    tags_sql("user", "user_evaluation"),
)
def _(t: Tables) -> DataFrame:
    owners = t["mod_life_style"]
    rows = ev.evaluate_tags(
        t["user_evaluation"],
        ["demands"],
        "persona",
        ev.tag_texts(owners, "persona_id", "motivation_ids", t["mod_motivation"]),
    )
    return ev.evaluate_tags(
        rows, ["occasion"], "persona", ev.tag_texts(owners, "persona_id", "occasion_ids", t["mod_occasion"])
    )


for _twin in ("item", "user"):

    @query(
        f"evaluate_script_{_twin}",
        f"{_twin}_evaluation {_twin}_property",
        script_sql(_twin, f"{_twin}_evaluation", f"{_twin}_property"),
    )
    def _(t: Tables, twin=_twin) -> DataFrame:
        return ev.evaluate_script(
            t[f"{twin}_evaluation"], t[f"{twin}_property"], f"{twin}Key", t[f"mod_{twin}_evaluation"], twin
        )


BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY userKey ORDER BY scoreHierarchy DESC NULLS LAST,
       scorePhase DESC NULLS LAST, scorePersona DESC NULLS LAST, personaId) AS n FROM {}) b WHERE n = 1"""


@query(
    "evaluate_best_persona",
    "user_evaluation user_persona",
    f"""SELECT e.userKey, e.parent, e.evaluation, e.weight, e.type, e.script, e.category, b.personaId AS persona, e.featured,
       e.score, CASE WHEN e.type = 'persona' THEN b.personaId ELSE e.text END AS text,
       CASE WHEN e.type = 'persona' THEN 'ready' ELSE e.status END AS status, e.priority, e.revision
    FROM user_evaluation e JOIN ({BEST.format('user_persona')}) b ON b.userKey = e.userKey""",
)
def _(t: Tables) -> DataFrame:
    return ev.evaluate_best_persona(t["user_evaluation"], t["user_persona"])


_WAYS = {
    "item": f"""CASE WHEN lower(type) IN ({WEIGHTED['item']}) THEN 'weighted' WHEN type IN ('satisfy', 'satisify') THEN 'motivation'
       WHEN type = 'context' THEN 'occasion' WHEN type IN ('ignore', 'do-not-care') THEN 'ignore' ELSE 'script' END""",
    "user": f"""CASE WHEN type IN ({WEIGHTED['user']}) THEN 'weighted' WHEN type = 'demands' THEN 'motivation'
       WHEN type = 'occasion' THEN 'occasion' WHEN type = 'persona' THEN 'persona'
       WHEN type IN ('hierarchy', 'phase', 'style') THEN 'ignore' ELSE 'script' END""",
}
for _twin in ("item", "user"):

    @query(f"route_by_type_{_twin}", f"{_twin}_evaluation", f"SELECT *, {_WAYS[_twin]} AS route FROM {_twin}_evaluation")
    def _(t: Tables, twin=_twin) -> DataFrame:
        return ev.route_by_type(t[f"{twin}_evaluation"], twin)


# --- copies of the results -------------------------------------------------------------------------------


def _number(text: str) -> str:
    return f"regexp_replace(CAST(CAST({text} AS DOUBLE) AS VARCHAR), '[.]0$', '')"


def _result(type_: str, evaluation: str, key: str, owner: str) -> str:
    """``"type":value`` of a featured result, or null."""
    return f"""(SELECT '"{type_}":' || coalesce('"' || r.text || '"', {_number('r.score')}) FROM {evaluation} r
        WHERE r.{key} = {owner} AND r.type = '{type_}' AND r.featured AND r.status = 'ready'
          AND (r.score IS NOT NULL OR r.text IS NOT NULL))"""


def item_document_sql(evaluation: str, types: list[str]) -> str:
    """Item documents with results, fields in code point order."""
    fields = {
        "brand": "'\"brand\":\"' || p_brand || '\"'",
        "price": f"'\"price\":{{\"sale\":' || {_number('p_retailprice')} || '}}'",
        "props": "'\"props\":[{\"k\":\"size\",\"v\":' || CAST(p_size AS VARCHAR) || '}]'",
        "tagging": "'\"tagging\":' || CASE WHEN mod(p_partkey, 2) = 1 THEN 'null' ELSE '\"' || p_name || '\"' END",
        "tags": "'\"tags\":[\"' || p_type || '\",\"' || p_brand || '\"]'",
        "title": "'\"title\":\"' || p_name || '\"'",
    }
    fields.update({ty: _result(ty, evaluation, "itemKey", "d._key") for ty in types})
    body = ", ".join(fields[f] for f in sorted(fields))
    return f"""SELECT d._key, d.category,
       CASE WHEN h.k IS NOT NULL THEN '{{' || concat_ws(',', {body}) || '}}' ELSE d.doc END AS doc,
       CASE WHEN h.k IS NOT NULL THEN 'pending' ELSE d.status END AS status, d.index
    FROM item_docs d JOIN part ON CAST(p_partkey AS VARCHAR) = d._key
    LEFT JOIN (SELECT DISTINCT itemKey AS k FROM {evaluation} WHERE featured AND status = 'ready'
               AND (score IS NOT NULL OR text IS NOT NULL)) h ON h.k = d._key"""


@query(
    "sync_features_item",
    "item_docs item_evaluation",
    item_document_sql("item_evaluation", ["a", "B", "x", "y", "style", "context"]),
)
def _(t: Tables) -> DataFrame:
    return ev.sync_features(t["item_docs"], t["item_evaluation"], "itemKey")


_USER_RESULTS = ", ".join(
    _result(ty, "user_evaluation", "userKey", "d._key")
    for ty in ("brand::tags", "culture", "demands", "economy", "occasion", "society")
)


@query(
    "sync_features_user",
    "user_docs user_evaluation",
    f"""SELECT d._key,
       CASE WHEN h.k IS NOT NULL THEN '{{"account":{{"balance":' || {_number('c_acctbal')} || '}},"evaluate":{{'
         || concat_ws(',', {_USER_RESULTS}) || '}},"name":"' || c_name || '","nation":' || CAST(c_nationkey AS VARCHAR)
         || ',"segment":"' || c_mktsegment || '"}}' ELSE d.doc END AS doc,
       CASE WHEN h.k IS NOT NULL THEN 'pending' ELSE d.status END AS status, d.isRecommend, d.query, d.tags
    FROM user_docs d JOIN customer ON CAST(c_custkey AS VARCHAR) = d._key
    LEFT JOIN (SELECT DISTINCT userKey AS k FROM user_evaluation WHERE featured AND status = 'ready'
               AND (score IS NOT NULL OR text IS NOT NULL)) h ON h.k = d._key""",
)
def _(t: Tables) -> DataFrame:
    return ev.sync_features(t["user_docs"], t["user_evaluation"], "userKey", nest="evaluate")


@query(
    "sync_user_query",
    "user_query user_evaluation",
    """SELECT q.userKey, q.category, q.type, q.subType, q.field, coalesce(e.result, q.text) AS text,
       CASE WHEN e.result IS NOT NULL THEN 'ready' ELSE q.status END AS status,
       q.revision + CASE WHEN e.result IS NOT NULL THEN 1 ELSE 0 END AS revision
    FROM user_query q LEFT JOIN (
      SELECT userKey, category, CASE WHEN type = 'brand::tags' THEN 'brand' ELSE '-' END AS subType,
             CASE WHEN type = 'brand::tags' THEN 'tags' ELSE type END AS field,
             coalesce(text, CAST(CAST(score AS DOUBLE) AS VARCHAR)) AS result
      FROM user_evaluation WHERE featured AND status = 'ready' AND trim(coalesce(text, CAST(score AS VARCHAR))) <> ''
    ) e ON e.userKey = q.userKey AND e.category = q.category AND e.subType = q.subType AND e.field = q.field""",
)
def _(t: Tables) -> DataFrame:
    return ev.sync_user_query(t["user_query"], t["user_evaluation"])


# --- profiles --------------------------------------------------------------------------------------------

_PROFILE = """SELECT coalesce(p.userKey, e.userKey) AS userKey, coalesce(p.property, e.type) AS name,
       CASE WHEN e.userKey IS NOT NULL THEN CAST(CAST(e.score AS DOUBLE) AS VARCHAR) ELSE p.value END AS var, p.value,
       CASE WHEN e.userKey IS NOT NULL THEN e.score ELSE p.score END AS score, p.rank, e.text
    FROM user_property p FULL JOIN user_evaluation e ON e.userKey = p.userKey AND e.type = p.property"""


@query("profile_rows", "user_property user_evaluation", _PROFILE)
def _(t: Tables) -> DataFrame:
    return profile_rows(t["user_property"], t["user_evaluation"], "userKey")


@query(
    "entity_profile",
    "user_property user_evaluation",
    f"""SELECT userKey, name, var, value, CAST(score AS DOUBLE) AS score, rank, text FROM ({_PROFILE}) x
    WHERE name IN ('segment', 'economy', 'brand::tags')""",
)
def _(t: Tables) -> DataFrame:
    profile = entity_profile(
        t["user_property"], t["user_evaluation"], "userKey", ["segment", "economy", "brand::tags", "absent"]
    )
    return profile.select("userKey", F.explode("p").alias("name", "v")).where("v IS NOT NULL").select("userKey", "name", "v.*")


# --- the item chain --------------------------------------------------------------------------------------

CHAIN_VIEWS = (
    "item_docs category_tree mod_item_dimension int_item_dimension_measure mod_item_evaluation "
    "int_item_evaluation_dimension mod_item_category mod_motivation mod_occasion item_property"
)
_BARE_MEASURE = """SELECT d._key AS itemKey, m.parent_id AS parent, m.id AS dimension, m.weight,
       CAST(NULL AS DECIMAL(18,6)) AS score, 'pending' AS status, 0 AS priority, 1 AS revision
    FROM item_docs d JOIN category_tree c ON c.name = d.category JOIN mod_item_dimension m ON m.category = c.id"""
_BARE_EVALUATION = """SELECT d._key AS itemKey, m.parent_id AS parent, m.id AS evaluation, m.weight, m.type, m.script, m.category,
       true AS featured, CAST(NULL AS VARCHAR) AS text, 0 AS priority, 1 AS revision,
       CAST(NULL AS DECIMAL(18,6)) AS score, 'pending' AS status
    FROM item_docs d JOIN category_tree c ON c.name = d.category JOIN mod_item_evaluation m ON m.category = c.id"""
_CHAIN = f"""WITH m0 AS ({_BARE_MEASURE}),
    m1 AS ({leaf_sql('item', 'm0', 'item_property')}),
    m2 AS ({rollup_sql('itemKey', 'm1', 'dimension', 'mod_item_dimension', measured_ids('item'), ['itemKey', *MEASURE_COLUMNS])}),
    e0 AS ({_BARE_EVALUATION}),
    e1 AS ({weighted_sql('item', 'e0', 'm2')}),
    e2 AS ({tags_sql('item', 'e1')}),
    e3 AS ({script_sql('item', 'e2', 'item_property')}),
    e4 AS ({rollup_sql('itemKey', 'e3', 'evaluation', 'mod_item_evaluation', evaluated_ids('item'), EVALUATION_COLUMNS['item'])})
    """


def chain_columns(df: DataFrame) -> DataFrame:
    return df.drop("priority")


@query(
    "item_scoring",
    CHAIN_VIEWS,
    _CHAIN
    + "SELECT itemKey, parent, evaluation, weight, type, script, category, featured, text, revision, score, status FROM e4",
)
def _(t: Tables) -> DataFrame:
    return chain_columns(scored_items(t["item_docs"], t["item_value"], t.some(*ITEM_CONF.split())))


@query(
    "item_scored_documents",
    CHAIN_VIEWS,
    _CHAIN
    + item_document_sql(
        "e4", ["perform", "a", "B", "c", "cost", "x", "y", "constraint", "satisify", "satisfy", "context", "style"]
    ),
)
def _(t: Tables) -> DataFrame:
    return scored_documents(t["item_docs"], t["item_value"], t.some(*ITEM_CONF.split()))


# --- the user chain --------------------------------------------------------------------------------------

USER_CONF = (
    "mod_user_measure mod_user_dimension int_user_dimension_measure mod_user_evaluation int_user_evaluation_dimension "
    "mod_motivation mod_occasion mod_life_style"
)
_USER_CHAIN = f"""WITH m0 AS (SELECT d._key AS userKey, m.parent_id AS parent, m.id AS dimension, m.weight,
       CAST(NULL AS DECIMAL(18,6)) AS score, 'pending' AS status, 0 AS priority, 1 AS revision
       FROM user_docs d, mod_user_dimension m),
    m1 AS ({leaf_sql('user', 'm0', 'user_property')}),
    m2 AS ({rollup_sql('userKey', 'm1', 'dimension', 'mod_user_dimension', measured_ids('user'), ['userKey', *MEASURE_COLUMNS])}),
    e0 AS (SELECT d._key AS userKey, m.parent_id AS parent, m.id AS evaluation, m.weight, m.type, m.script, m.category,
       CAST(NULL AS VARCHAR) AS persona, true AS featured, CAST(NULL AS VARCHAR) AS text, 0 AS priority, 1 AS revision,
       CAST(NULL AS DECIMAL(18,6)) AS score, 'pending' AS status FROM user_docs d, mod_user_evaluation m),
    e1 AS ({weighted_sql('user', 'e0', 'm2')}),
    best AS (SELECT userKey AS owner, personaId AS won FROM ({BEST.format('user_persona')}) b),
    e2 AS (SELECT e1.* REPLACE (won AS persona, CASE WHEN type = 'persona' THEN won ELSE text END AS text,
       CASE WHEN type = 'persona' AND won IS NOT NULL THEN 'ready' ELSE status END AS status)
       FROM e1 LEFT JOIN best ON owner = userKey),
    e3 AS ({tags_sql('user', 'e2')}),
    e4 AS ({script_sql('user', 'e3', 'user_property')}),
    e5 AS ({rollup_sql('userKey', 'e4', 'evaluation', 'mod_user_evaluation', evaluated_ids('user'), EVALUATION_COLUMNS['user'])})
    """


@query(
    "user_scoring",
    f"user_docs user_property user_persona {USER_CONF}",
    _USER_CHAIN + "SELECT * EXCLUDE (priority) FROM e5",
)
def _(t: Tables) -> DataFrame:
    return chain_columns(scored_users(t["user_docs"], t["user_value"], t["user_persona"], t.some(*USER_CONF.split())))
