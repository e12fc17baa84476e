"""New documents to property rows, labelling candidates and scoring tasks.

One function serves items and users; ``key`` names the entity column.  Items meet
the configuration of their category, users meet all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import field_name, path_depth, sub_type
from tallyweave.operators.pairing import pair_every
from tallyweave.operators.tasks import LEAF_PRIORITY
from tallyweave.operators.upsert import insert_ignore, insert_or_bump_revision, update_from

# Fixed values.
MEASURE_PRIORITY = 400
EVALUATION_PRIORITY = {
    "perform": 800,
    "cost": 700,
    "constraint": 600,
    "satisfy": 500,
    "context": 400,
    "style": 300,
}


def _first() -> dict[str, Column]:
    """State of a row that has just been put in."""
    return {"status": F.lit("pending"), "revision": F.lit(1)}


def property_rows(target: DataFrame, flat: DataFrame, keys: list[str]) -> DataFrame:
    """Put flattened rows into the property table; a repeated row bumps its revision."""
    return insert_or_bump_revision(target, flat.select(*keys), keys, {"status": F.lit("pending")})


def label_candidates(target: DataFrame, flat: DataFrame, keys: list[str]) -> DataFrame:
    """Put the distinct values into the labelling table as pending rows."""
    return insert_ignore(target, flat.select(*keys), keys, _first())


def _with_config(entities: DataFrame, config: DataFrame, key: str, categories: DataFrame | None) -> DataFrame:
    """Entities (``key``, and the category name for items) with their configuration rows."""
    if categories is None:
        return pair_every(entities.select(key), config, key)
    named = config.withColumnRenamed("category", "category_id").join(
        categories.select(F.col("id").alias("category_id"), F.col("name").alias("category")), "category_id"
    )
    return entities.select(key, "category").join(named, "category").drop("category")


def _task(priority: Column) -> list[Column]:
    return [
        F.lit("pending").alias("status"),
        priority.cast("int").alias("priority"),
        F.lit(1).alias("revision"),
    ]


def measure_tasks(
    entities: DataFrame, dims: DataFrame, key: str, categories: DataFrame | None = None
) -> DataFrame:
    """Every entity with every dimension (of its category); deeper nodes have higher priority."""
    return _with_config(entities, dims, key, categories).select(
        key,
        F.col("parent_id").alias("parent"),
        F.col("id").alias("dimension"),
        "weight",
        *_task(F.lit(MEASURE_PRIORITY) + path_depth(F.col("parent_ids"))),
    )


def measure_property_tasks(
    entities: DataFrame, dim_measures: DataFrame, key: str, categories: DataFrame | None = None
) -> DataFrame:
    """Every entity with the measured properties of its dimensions."""
    return _with_config(entities, dim_measures, key, categories).select(
        key,
        F.col("dimension_id").alias("dimension"),
        F.col("measure_id").alias("property"),
        "weight",
        *_task(F.lit(LEAF_PRIORITY)),
    )


def promote_measured(measures: DataFrame, dim_measures: DataFrame) -> DataFrame:
    """Measure tasks whose dimension has properties of its own become leaf tasks.

    The mapping rows are the same for all entities, so the configuration decides and
    the task tables are not joined with each other.
    """
    leaf = dim_measures.select(F.col("dimension_id").alias("dimension")).distinct()
    return update_from(
        measures, leaf.withColumn("priority", F.lit(LEAF_PRIORITY)), ["dimension"], ["priority"]
    )


def _base_priority(type_: Column) -> Column:
    base = F.create_map(*[F.lit(x) for pair in EVALUATION_PRIORITY.items() for x in pair])
    return base[type_]


def evaluate_tasks(
    entities: DataFrame, evals: DataFrame, key: str, categories: DataFrame | None = None
) -> DataFrame:
    """Every entity with every evaluation (of its category); priority by type and depth."""
    category = F.col("category_id") if categories is not None else F.col("category")
    return _with_config(entities, evals, key, categories).select(
        key,
        F.col("parent_id").alias("parent"),
        F.col("id").alias("evaluation"),
        "weight",
        "type",
        "script",
        category.alias("category"),
        *_task(F.coalesce(_base_priority(F.col("type")), F.lit(0)) + path_depth(F.col("parent_ids"))),
    )


def _leaf_priority(type_: Column) -> Column:
    return F.coalesce(_base_priority(type_) + LEAF_PRIORITY, F.lit(0))


def evaluation_mapping(evals: DataFrame, eval_dims: DataFrame) -> DataFrame:
    """Configured dimensions of each evaluation, with its type and script."""
    described = evals.select(F.col("id").alias("evaluation_id"), "type", "script")
    return eval_dims.join(described, "evaluation_id")


def evaluation_measure_tasks(
    entities: DataFrame,
    evals: DataFrame,
    eval_dims: DataFrame,
    key: str,
    categories: DataFrame | None = None,
) -> DataFrame:
    """Every entity with the dimensions of its evaluations."""
    mapping = evaluation_mapping(evals, eval_dims)
    category = [F.col("category_id").alias("category")] if categories is not None else []
    return _with_config(entities, mapping, key, categories).select(
        key,
        F.col("evaluation_id").alias("evaluation"),
        F.col("dimension_id").alias("dimension"),
        "weight",
        "type",
        "script",
        *category,
        *_task(_leaf_priority(F.col("type"))),
    )


def promote_evaluated(evaluations: DataFrame, evals: DataFrame, eval_dims: DataFrame) -> DataFrame:
    """Evaluations with dimensions of their own take the priority of their leaf tasks."""
    leaf = (
        evaluation_mapping(evals, eval_dims)
        .select(F.col("evaluation_id").alias("evaluation"), "type")
        .distinct()
        .withColumn("priority", _leaf_priority(F.col("type")))
    )
    return update_from(evaluations, leaf, ["evaluation", "type"], ["priority"])


def query_items(users: DataFrame, evals: DataFrame) -> DataFrame:
    """Every user with one query row per evaluation; ``brand::tags`` is field ``tags`` of ``brand``."""
    fields = evals.select(
        "category",
        F.lit("match").alias("type"),
        sub_type(F.col("type")).alias("subType"),
        field_name(F.col("type")).alias("field"),
    )
    return pair_every(users.select("userKey"), fields, "userKey").select(
        "userKey",
        "category",
        "type",
        "subType",
        "field",
        F.lit(None).cast("string").alias("text"),
        F.lit("pending").alias("status"),
        F.lit(1).alias("revision"),
    )


PERSONA_KEYS = ["userKey", "hierarchyId", "phaseId", "personaId"]


def persona_tasks(target: DataFrame, users: DataFrame, personas: DataFrame) -> DataFrame:
    """Put every user with every persona into the matching table."""
    ids = personas.select(
        F.col("hierarchy_id").alias("hierarchyId"), F.col("phase_id").alias("phaseId"), F.col("id").alias("personaId")
    )
    new = pair_every(users.select("userKey"), ids, "userKey")
    return insert_or_bump_revision(target, new, PERSONA_KEYS, {"status": F.lit("pending")})


def filter_tasks(target: DataFrame, users: DataFrame) -> DataFrame:
    """One pending filter row per new user."""
    return insert_ignore(target, users.select("userKey"), ["userKey"], _first())
