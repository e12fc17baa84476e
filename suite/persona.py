"""Persona matching and search filter queries, and the whole user chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import ORACLES, QUERIES, Tables, query
from suite.scoring import BEST
from tallyweave.operators import filters, persona
from tallyweave.plans.user_filter import changed_user_filters, filter_documents, matched_personas, user_filters
from tallyweave.sources.tables import stage

SCORED = "user_persona user_property user_evaluation"
CONF = "mod_hierarchy mod_phase mod_persona"

_P = "(SELECT {} FROM user_property q WHERE q.userKey = t.userKey AND q.property = '{}')"
_E = "(SELECT {} FROM user_evaluation q WHERE q.userKey = t.userKey AND q.type = '{}')"


def _p(column: str, name: str) -> str:
    return _P.format(column, name)


_HIERARCHY = f"""CASE hierarchyId
       WHEN 'h1' THEN CASE WHEN CAST({_p('value', 'account.balance')} AS DOUBLE) > 5000 THEN 1.0 ELSE 0.0 END
       WHEN 'h2' THEN CAST({_p('score', 'segment')} AS DOUBLE) * 2 END"""
_PHASE = f"""CASE phaseId
       WHEN 'ph1' THEN CAST({_p('rank', 'nation')} + 1 AS DOUBLE)
       WHEN 'ph2' THEN CASE WHEN {_p('value', 'segment')} = 'BUILDING' THEN 1.0 ELSE 0.0 END
       WHEN 'ph3' THEN CAST({_E.format('score', 'economy')} AS DOUBLE) END"""
_PERSONA = f"""CASE personaId
       WHEN 'per1' THEN CAST({_p('rank', 'nation')} AS DOUBLE)
       WHEN 'per2' THEN CAST({_E.format('score', 'economy')} AS DOUBLE)
       WHEN 'per3' THEN CAST({_p('value', 'nation')} AS DOUBLE)
       WHEN 'per4' THEN CASE WHEN {_E.format('text', 'brand::tags')} = 't1' THEN 1.0 ELSE 0.0 END
       WHEN 'per6' THEN CAST({_p('rank', 'segment')} + {_p('rank', 'account.balance')} AS DOUBLE) END"""


def _scored(hierarchy: bool = False, phase: bool = False, persona_: bool = False) -> str:
    def col(name: str, expr: str, on: bool) -> str:
        return f"coalesce(CAST({expr} AS DOUBLE), {name}) AS {name}" if on else name

    return f"""SELECT userKey, hierarchyId, phaseId, personaId, {col('scoreHierarchy', _HIERARCHY, hierarchy)},
       {col('scorePhase', _PHASE, phase)}, {col('scorePersona', _PERSONA, persona_)}, status, revision FROM user_persona t"""


@query("score_hierarchy", SCORED, _scored(hierarchy=True))
def _(t: Tables) -> DataFrame:
    return persona.score_hierarchy(t["user_persona"], t["user_property"], t["user_evaluation"], t["mod_hierarchy"])


@query("score_phase", SCORED, _scored(phase=True))
def _(t: Tables) -> DataFrame:
    return persona.score_phase(t["user_persona"], t["user_property"], t["user_evaluation"], t["mod_phase"])


@query("score_persona", SCORED, _scored(persona_=True))
def _(t: Tables) -> DataFrame:
    return persona.score_persona(t["user_persona"], t["user_property"], t["user_evaluation"], t["mod_persona"])


@query("matched_personas", SCORED, _scored(True, True, True))
def _(t: Tables) -> DataFrame:
    return matched_personas(
        t["user_persona"], t["user_property"], t["user_evaluation"], t.some(*CONF.split())
    )


_KEPT = "userKey, hierarchyId, phaseId, personaId, scoreHierarchy, scorePhase, scorePersona, status, revision"


@query("best_persona", "user_persona", f"SELECT {_KEPT} FROM ({BEST.format('user_persona')}) b")
def _(t: Tables) -> DataFrame:
    return persona.best_persona(t["user_persona"])


def _clause(name: str) -> str:
    one = """'{"' || type || '":{"' || field || '":"' || text || '"}}'"""
    chosen = f"lower(category) = '{name}'"
    return f"'[' || string_agg({one}, ',' ORDER BY type, field, text) FILTER (WHERE {chosen}) || ']' AS {name}"


_CLAUSES = f"""SELECT userKey, {_clause('must')}, {_clause('must_not')}, {_clause('should')}, {_clause('filter')}
    FROM user_query WHERE category <> '' AND field <> '' AND text <> ''
      AND lower(category) IN ('must', 'must_not', 'should', 'filter') GROUP BY userKey"""


@query("bool_clauses", "user_query", _CLAUSES)
def _(t: Tables) -> DataFrame:
    rows = filters.bool_clauses(t["user_query"])
    return rows.select("userKey", *[F.to_json(c).alias(c) for c in filters.CLAUSES])


def _gauss(field: str, origin: str) -> str:
    return f"""'{{"gauss":{{"{field}":{{"origin":' || CAST({origin} AS VARCHAR) || ',"scale":0.25}}}}}}'"""


_DECAY = " || ',' || ".join(
    _gauss(f, f"coalesce(TRY_CAST({c} AS DOUBLE), 0.5)") for c, f in filters.PERSONA_FIELDS.items()
)


def _persona_decay(personas: str) -> str:
    return f"""SELECT b.userKey, '[' || {_DECAY} || ']' AS personaDecay
    FROM ({BEST.format(personas)}) b JOIN mod_persona m ON m.id = b.personaId"""


@query("persona_decay", "user_persona mod_persona", _persona_decay("user_persona"))
def _(t: Tables) -> DataFrame:
    decay = filters.persona_decay(persona.best_persona(t["user_persona"]), t["mod_persona"])
    return decay.select("userKey", F.to_json("personaDecay").alias("personaDecay"))


_COSTS = ", ".join(
    "max(CASE WHEN type = '{0}' THEN {1} END)".format(
        ty, _gauss(f, "coalesce(CAST(score AS DOUBLE), 0.5)")
    )
    for ty, f in filters.COST_FIELDS.items()
)
_COST = f"""SELECT userKey, '[' || concat_ws(',', {_COSTS}) || ']' AS costDecay FROM user_evaluation
    WHERE type IN ('economy', 'society', 'culture') AND NOT (type = 'culture' AND mod(CAST(userKey AS BIGINT), 5) = 0)
    GROUP BY userKey"""


def _some_costs(t: Tables) -> DataFrame:
    """Evaluations where every fifth user has no culture score."""
    no_culture = (F.col("type") == "culture") & (F.col("userKey").cast("bigint") % 5 == 0)
    return t["user_evaluation"].where(~no_culture)


@query("cost_decay", "user_evaluation", _COST)
def _(t: Tables) -> DataFrame:
    return filters.cost_decay(_some_costs(t)).select("userKey", F.to_json("costDecay").alias("costDecay"))


_RANK = (
    '{"script_score":{"script":{"params":{"a":5,"b":2,"c":3},"source":"Math.pow(params.a, params.b*doc[\'\'rank.count\'\']'
    '.value+params.c*doc[\'\'rank.score\'\'].value)"}}}'
)


@query("script_score_function", "user_filter", f"SELECT userKey, '{_RANK}' AS function FROM user_filter")
def _(t: Tables) -> DataFrame:
    return t["user_filter"].select("userKey", F.to_json(filters.script_score_function()).alias("function"))


def _filter_sql(personas: str) -> str:
    lists = ", ".join(f"""'"{c}":' || c.{c}""" for c in filters.CLAUSES)
    inside = "substr({0}, 2, length({0}) - 2)"
    return f"""WITH scored AS ({personas}), clauses AS ({_CLAUSES}), decay AS ({_persona_decay('scored')}), cost AS ({_COST})
    SELECT f.userKey, '{{"function_score":{{"query":{{"bool":{{' || concat_ws(',', {lists}) || '}}}},"functions":['
       || concat_ws(',', {inside.format('d.personaDecay')}, {inside.format('x.costDecay')}, '{_RANK}')
       || '],"boost":"2","score_mode":"multiply","boost_mode":"multiply"}}}}' AS query
    FROM user_filter f LEFT JOIN clauses c ON c.userKey = f.userKey LEFT JOIN decay d ON d.userKey = f.userKey
    LEFT JOIN cost x ON x.userKey = f.userKey WHERE f.status = 'pending'"""


@query(
    "function_score",
    "user_filter user_query user_persona mod_persona user_evaluation",
    _filter_sql("SELECT * FROM user_persona"),
)
def _(t: Tables) -> DataFrame:
    return filters.function_score(
        t["user_filter"].where("status = 'pending'"),
        filters.bool_clauses(t["user_query"]),
        filters.persona_decay(persona.best_persona(t["user_persona"]), t["mod_persona"]),
        filters.cost_decay(_some_costs(t)),
    )


@query(
    "user_filter_flow",
    f"user_filter user_query mod_persona {SCORED}",
    _filter_sql(_scored(True, True, True)),
)
def _(t: Tables) -> DataFrame:
    return user_filters(
        t["user_filter"].where("status = 'pending'"),
        t["user_persona"],
        t["user_query"],
        t["user_property"],
        _some_costs(t),
        t.some(*CONF.split()),
    )


@query(
    "filter_documents",
    "user_docs",
    f"""SELECT d.* REPLACE (coalesce(f.query, d.query) AS query)
    FROM user_docs d LEFT JOIN ({ORACLES["user_filter_flow"]}) f ON f.userKey = d._key""",
)
def _(t: Tables) -> DataFrame:
    return filter_documents(t["user_docs"], QUERIES["user_filter_flow"](t.spark, t.sf_dir))


# The run before saw other queries of every seventh user and other personas of every eleventh; the documents hold
# what it made.  Only these users are asked again, and all documents are as if all had been.
@query(
    "changed_user_filters",
    f"user_docs user_filter user_query mod_persona {SCORED}",
    f"""SELECT d.* REPLACE (f.query AS query)
    FROM user_docs d JOIN ({_filter_sql(_scored(True, True, True)).replace("WHERE f.status = 'pending'", "")}) f ON f.userKey = d._key""",
)
def _(t: Tables) -> DataFrame:
    conf = t.some(*CONF.split())
    queries, personas = t["user_query"], t["user_persona"]
    number = F.col("userKey").cast("bigint")
    asked = F.when(number % 7 == 0, F.lit("asked before")).otherwise(F.col("text"))
    scored = F.when(number % 11 == 0, F.lit(0.25)).otherwise(F.col("scorePersona"))
    before = [personas.withColumn("scorePersona", scored), queries.withColumn("text", asked), t["user_property"], _some_costs(t)]
    docs, last = changed_user_filters(t["user_docs"], None, *before, conf)
    now = [personas, queries, t["user_property"], _some_costs(t)]
    return changed_user_filters(stage(docs, "filtered-documents"), last, *now, conf)[0]
