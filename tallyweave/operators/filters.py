"""The personal search filter: a scored boolean query document per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
CLAUSES = ["must", "must_not", "should", "filter"]
DECAY_SCALE = 0.25
DECAY_ORIGIN = 0.5
PERSONA_FIELDS = {"alpha": "a", "beta": "b", "gamma": "c", "delte": "d", "epsilon": "e"}
COST_FIELDS = {"economy": "x", "society": "y", "culture": "z"}
RANK_PARAMS = {"a": 5, "b": 2, "c": 3}
RANK_SOURCE = "Math.pow(params.a, params.b*doc['rank.count'].value+params.c*doc['rank.score'].value)"
BOOST = "2"
MODE = "multiply"


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def bool_clauses(user_query: DataFrame) -> DataFrame:
    """(userKey, must, must_not, should, filter): clause lists, null where empty.

    A list holds at most one clause per configured query row of the user.
    """
    clause = F.struct("type", "field", "text")
    kind = F.lower("category")
    rows = user_query.where(_filled("category") & _filled("field") & _filled("text") & kind.isin(CLAUSES))

    def clauses(name: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(kind == name, clause)))
        maps = F.transform(found, lambda c: F.create_map(c["type"], F.create_map(c["field"], c["text"])))
        return F.when(F.size(found) > 0, maps).alias(name)

    return rows.groupBy("userKey").agg(*[clauses(name) for name in CLAUSES])


def _gauss(field: str, origin: Column) -> Column:
    setting = F.struct(origin.alias("origin"), F.lit(DECAY_SCALE).alias("scale"))
    return F.create_map(F.lit("gauss"), F.create_map(F.lit(field), setting))


def _origin(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(DECAY_ORIGIN))


def persona_decay(best: DataFrame, personas: DataFrame) -> DataFrame:
    """(userKey, personaDecay): five gauss functions around the persona's values."""
    functions = F.array(*[_gauss(f, _origin(F.col(c))) for c, f in PERSONA_FIELDS.items()])
    settings = personas.select(F.col("id").alias("personaId"), functions.alias("personaDecay"))
    return best.select("userKey", "personaId").join(settings, "personaId").select("userKey", "personaDecay")


def cost_decay(user_evaluation: DataFrame) -> DataFrame:
    """(userKey, costDecay): gauss functions around the cost scores the user has.

    Of several evaluations of a type the one with the smallest id counts.
    """
    rows = user_evaluation.where(F.col("type").isin(list(COST_FIELDS)))
    picked = rows.groupBy("userKey").agg(
        *[
            F.min(F.when(F.col("type") == t, F.struct("evaluation", "score"))).alias(t)
            for t in COST_FIELDS
        ]
    )
    functions = F.array(
        *[
            F.when(F.col(t).isNotNull(), _gauss(f, F.coalesce(F.col(t)["score"].cast("double"), F.lit(DECAY_ORIGIN))))
            for t, f in COST_FIELDS.items()
        ]
    )
    return picked.select("userKey", F.filter(functions, lambda x: x.isNotNull()).alias("costDecay"))


def script_score_function() -> Column:
    """The constant function that scores by rank."""
    params = F.struct(*[F.lit(v).alias(k) for k, v in RANK_PARAMS.items()])
    script = F.struct(params.alias("params"), F.lit(RANK_SOURCE).alias("source"))
    return F.struct(F.struct(script.alias("script")).alias("script_score"))


def function_score(
    users: DataFrame, clauses: DataFrame, persona_functions: DataFrame, cost_functions: DataFrame
) -> DataFrame:
    """(userKey, query): the whole search query of each user as JSON.

    All inputs are grouped by user already, so the joins reuse that partitioning; a user
    named several times has one query.  Clause lists that are null are left out of the JSON.
    """
    joined = (
        users.select("userKey").distinct()
        .join(clauses, "userKey", "left")
        .join(persona_functions, "userKey", "left")
        .join(cost_functions, "userKey", "left")
    )
    none = F.array().cast("array<string>")
    functions = F.concat(
        F.coalesce(F.transform("personaDecay", lambda x: F.to_json(x)), none),
        F.coalesce(F.transform("costDecay", lambda x: F.to_json(x)), none),
        F.array(F.to_json(script_score_function())),
    )
    lists = F.concat_ws(
        ",",
        *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f'"{c}":'), F.to_json(c))) for c in CLAUSES],
    )
    query = F.concat(
        F.lit('{"function_score":{"query":{"bool":{'),
        lists,
        F.lit('}},"functions":['),
        F.array_join(functions, ","),
        F.lit(f'],"boost":"{BOOST}","score_mode":"{MODE}","boost_mode":"{MODE}"}}}}'),
    )
    return joined.select("userKey", query.alias("query"))
