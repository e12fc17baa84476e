"""Evaluation results by type: tags, scripts, best persona, and where they are copied to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.scripts import MAX_SCRIPTS, read_scripts, variables_of, with_script_texts
from tallyweave.functions.text import blank, field_name, id_list, sub_type
from tallyweave.operators.persona import best_persona
from tallyweave.operators.profile import entity_profile
from tallyweave.operators.scoring import WEIGHTED_TYPES
from tallyweave.operators.upsert import update_from

# Which way an evaluation type is computed.
TAG_TYPES = {
    "item": {"satisfy": "motivation", "satisify": "motivation", "context": "occasion"},
    "user": {"demands": "motivation", "occasion": "occasion"},
}
PERSONA_TYPES = {"item": [], "user": ["persona"]}
IGNORED_TYPES = {"item": ["ignore", "do-not-care"], "user": ["hierarchy", "phase", "style"]}


def route(type_: Column, twin: str) -> Column:
    """How a type is computed: weighted, motivation, occasion, persona, ignore or script.

    User ``style`` has no rule yet, so it is left alone.
    """
    t = F.lower(type_)
    way = F.when(t.isin(WEIGHTED_TYPES[twin]), F.lit("weighted"))
    for name, target in TAG_TYPES[twin].items():
        way = way.when(t == name, F.lit(target))
    if PERSONA_TYPES[twin]:
        way = way.when(t.isin(PERSONA_TYPES[twin]), F.lit("persona"))
    return way.when(t.isin(IGNORED_TYPES[twin]), F.lit("ignore")).otherwise(F.lit("script"))


def route_by_type(evaluation: DataFrame, twin: str) -> DataFrame:
    """The evaluations with the way each is computed."""
    return evaluation.withColumn("route", route(F.col("type"), twin))


def tag_texts(owners: DataFrame, owner_id: str, csv_col: str, tags: DataFrame) -> DataFrame:
    """(owner, text): the names of the listed tags in list order, each with a space after it.

    A text is built from one list of one configuration row.
    """
    first = owners.groupBy(F.col(owner_id).alias("owner")).agg(F.min(csv_col).alias("ids"))
    listed = first.select("owner", F.posexplode(id_list(F.col("ids"))).alias("pos", "id"))
    named = listed.join(tags.select("id", "name"), "id")
    return (
        named.groupBy("owner")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("found"))
        .select("owner", F.concat(F.array_join("found.name", " "), F.lit(" ")).alias("text"))
    )


def evaluate_tags(
    evaluation: DataFrame, types: list[str], owner_col: str, texts: DataFrame
) -> DataFrame:
    """Text of the tag types by the owner in ``owner_col`` (category or persona).

    Evaluations without any tag stay as they are.
    """
    of_type = F.lower("type").isin(types)
    owned = evaluation.withColumn("__owner", F.when(of_type, F.col(owner_col)))
    new = texts.select(F.col("owner").alias("__owner"), "text", F.lit("ready").alias("status"))
    return update_from(owned, new, ["__owner"], ["text", "status"]).drop("__owner")


def evaluate_script(
    evaluation: DataFrame, property_: DataFrame, key: str, evals: DataFrame, twin: str, limit: int = MAX_SCRIPTS
) -> DataFrame:
    """Text of the script types: the configured expression over the entity's properties.

    Entities without properties and scripts without a result leave the row as it is.
    """
    scripted = evals.where(route(F.col("type"), twin) == "script")
    scripts = read_scripts(scripted, "id", "script", limit)
    profile = entity_profile(property_, None, key, variables_of(scripts.values()))
    owners = property_.select(key).distinct().withColumn("__owned", F.lit(True))
    of_script = route(F.col("type"), twin) == "script"
    known = owners.join(profile, key, "left")
    # only rows of scripts name one
    asked = F.when(of_script & F.col("__owned"), F.col("evaluation"))
    joined = with_script_texts(evaluation.join(known, key, "left"), {"__text": (asked, scripts)})
    found = F.col("__text").isNotNull()
    columns = {
        "text": F.coalesce("__text", "text").alias("text"),
        "status": F.when(found, F.lit("ready")).otherwise(F.col("status")).alias("status"),
    }
    return joined.select(*[columns.get(c, F.col(c)) for c in evaluation.columns])


def evaluate_best_persona(evaluation: DataFrame, user_persona: DataFrame) -> DataFrame:
    """Persona evaluations get the best persona as text; it is stamped on all rows of the user."""
    is_persona = F.lower("type") == "persona"
    asked = evaluation.where(is_persona).select("userKey").distinct()
    best = best_persona(user_persona).select("userKey", F.col("personaId").alias("__best"))
    joined = evaluation.join(best.join(asked, "userKey", "left_semi"), "userKey", "left")
    hit = F.col("__best").isNotNull()
    columns = {
        "persona": F.coalesce("__best", "persona").alias("persona"),
        "text": F.when(is_persona & hit, F.col("__best")).otherwise(F.col("text")).alias("text"),
        "status": F.when(is_persona & hit, F.lit("ready")).otherwise(F.col("status")).alias("status"),
    }
    return joined.select(*[columns.get(c, F.col(c)) for c in evaluation.columns])


def _featured(evaluation: DataFrame) -> DataFrame:
    """Results to copy out: featured, computed, with a score or a text."""
    return evaluation.where(
        F.col("featured") & (F.col("status") == "ready") & (F.col("score").isNotNull() | F.col("text").isNotNull())
    )


def sync_features(docs: DataFrame, evaluation: DataFrame, key: str, nest: str | None = None) -> DataFrame:
    """Documents with the featured results written into them, pending again.

    Items get them as fields of the document, users (``nest='evaluate'``) in one
    nested object.  Each result is first cut to one per entity and type.
    """
    value = F.coalesce(F.col("text").cast("variant"), F.col("score").cast("double").cast("variant"))
    results = (
        _featured(evaluation)
        .groupBy(key, "type")
        .agg(F.max(F.struct("evaluation", "text", "score")).alias("r"))
        .select(key, "type", "r.text", "r.score")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("type", value.alias("value")))).alias("__new"))
        .withColumnRenamed(key, "_key")
    )
    fields = F.col("__v").cast("map<string,variant>")
    added = F.col("__new")
    if nest:
        inner = F.coalesce(
            fields[nest].try_cast("map<string,variant>"), F.create_map().cast("map<string,variant>")
        )
        merged = F.map_concat(F.map_filter(inner, lambda k, _: ~F.map_contains_key(F.col("__new"), k)), added)
        added = F.create_map(F.lit(nest), F.parse_json(F.to_json(merged)))
    kept = F.map_filter(fields, lambda k, _: ~F.map_contains_key(added, k))
    # parsing the merged text once more puts the fields in one order
    text = F.to_json(F.parse_json(F.to_json(F.map_concat(kept, added))))
    # only documents with results are parsed, each once
    parsed = F.when(F.col("__new").isNotNull(), F.try_parse_json("doc"))
    joined = docs.join(results, "_key", "left").withColumn("__v", parsed)
    # documents that are no JSON stay as they are
    hit = F.col("__v").isNotNull()
    return joined.select(
        *[
            F.when(hit, text).otherwise(F.col("doc")).alias("doc")
            if c == "doc"
            else (F.when(hit, F.lit("pending")).otherwise(F.col(c)).alias(c) if c == "status" else F.col(c))
            for c in docs.columns
        ]
    )


def sync_user_query(user_query: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Non-empty featured results copied to the user's query rows, ready, revision raised."""
    keys = ["userKey", "category", "subType", "field"]
    text = F.coalesce(F.col("text"), F.col("score").cast("double").cast("string"))
    new = (
        _featured(evaluation)
        .where(~blank(F.col("category")) & ~blank(F.col("type")) & ~blank(text))
        .select(
            "userKey",
            "category",
            sub_type(F.col("type")).alias("subType"),
            field_name(F.col("type")).alias("field"),
            F.struct("evaluation", text.alias("text")).alias("__r"),
        )
        .groupBy(*keys)
        .agg(F.max("__r").alias("__r"), F.count(F.lit(1)).alias("__n"))
        .select(*keys, F.col("__r.text").alias("text"), F.lit("ready").alias("status"), "__n")
    )
    counted = user_query.withColumn("__n", F.lit(0).cast("bigint"))
    updated = update_from(counted, new, keys, ["text", "status", "__n"])
    return updated.withColumn("revision", (F.col("revision") + F.col("__n")).cast("int")).drop("__n")
