"""User documents to scored evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.enrich import fill_property_id, normalize
from tallyweave.operators.evaluation import (
    TAG_TYPES,
    evaluate_best_persona,
    evaluate_script,
    evaluate_tags,
    sync_features,
    tag_texts,
)
from tallyweave.operators.flatten import flatten_documents
from tallyweave.operators.load import evaluate_tasks, evaluation_mapping, measure_tasks
from tallyweave.operators.scoring import (
    WEIGHTED_TYPES,
    evaluate_by_dimension,
    evaluate_weighted,
    measure_by_dimension,
    measure_by_property,
)
from tallyweave.schemas import SCORE
from tallyweave.sources.tables import stage

KEY = "userKey"


def user_properties(docs: DataFrame, labels: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Property rows of the documents with ids and label scores."""
    flat = flatten_documents(docs.withColumnRenamed("_key", KEY), [KEY])
    rows = flat.distinct().select(
        "*",
        F.lit(None).cast("string").alias("propertyId"),
        F.lit(None).cast(SCORE).alias("score"),
        F.lit(None).cast("int").alias("rank"),
        F.lit("pending").alias("status"),
        F.lit(1).alias("revision"),
    )
    return normalize(fill_property_id(rows, conf["mod_user_measure"]), labels, ["property", "value"])


def user_measures(users: DataFrame, properties: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Scored measure tree of each user."""
    dims, measured = conf["mod_user_dimension"], conf["int_user_dimension_measure"]
    mapping = measured.select(F.col("dimension_id").alias("dimension"), F.col("measure_id").alias("property"), "weight")
    tasks = measure_tasks(users, dims, KEY).withColumn("score", F.lit(None).cast(SCORE))
    return measure_by_dimension(measure_by_property(tasks, mapping, properties, KEY), dims, measured, KEY)


def user_evaluations(
    users: DataFrame, properties: DataFrame, measures: DataFrame, user_persona: DataFrame, conf: dict[str, DataFrame]
) -> DataFrame:
    """Evaluations of each user: weighted, best persona and its tags, scripts, then the tree above them."""
    evals, eval_dims = conf["mod_user_evaluation"], conf["int_user_evaluation_dimension"]
    tasks = evaluate_tasks(users, evals, KEY).select(
        "*",
        F.lit(None).cast(SCORE).alias("score"),
        F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("string").alias("persona"),
        F.lit(True).alias("featured"),
    )
    mapping = evaluation_mapping(evals, eval_dims).select(
        F.col("evaluation_id").alias("evaluation"), "type", F.col("dimension_id").alias("dimension"), "weight"
    )
    rows = evaluate_weighted(tasks, mapping, measures, KEY, WEIGHTED_TYPES["user"])
    rows = evaluate_best_persona(rows, user_persona)
    styles = conf["mod_life_style"]
    for kind, csv_col, tags in (
        ("motivation", "motivation_ids", conf["mod_motivation"]),
        ("occasion", "occasion_ids", conf["mod_occasion"]),
    ):
        types = [t for t, k in TAG_TYPES["user"].items() if k == kind]
        rows = evaluate_tags(rows, types, "persona", tag_texts(styles, "persona_id", csv_col, tags))
    rows = evaluate_script(rows, properties, KEY, evals.where(F.col("script").isNotNull()), "user")
    parents = evals.select(F.col("parent_id").alias("id")).distinct()
    leaf_ids = evals.join(parents, "id", "left_anti").select("id")
    mapped = eval_dims.select(F.col("evaluation_id").alias("id"))
    return evaluate_by_dimension(rows, evals, leaf_ids.union(mapped).distinct(), KEY)


def scored_users(
    docs: DataFrame, labels: DataFrame, user_persona: DataFrame, conf: dict[str, DataFrame]
) -> DataFrame:
    """Documents to evaluations; properties and measures are read by several steps and written once."""
    users = docs.select(F.col("_key").alias(KEY))
    properties = stage(user_properties(docs, labels, conf), "user-properties")
    measures = stage(user_measures(users, properties, conf), "user-measures")
    return user_evaluations(users, properties, measures, user_persona, conf)


def scored_user_documents(
    docs: DataFrame, labels: DataFrame, user_persona: DataFrame, conf: dict[str, DataFrame]
) -> DataFrame:
    """Documents with their featured results in one nested object."""
    return sync_features(docs, scored_users(docs, labels, user_persona, conf), KEY, nest="evaluate")
