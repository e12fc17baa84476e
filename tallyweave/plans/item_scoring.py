"""Item documents to scored evaluations, written back to the documents; ``item_index`` publishes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.enrich import fill_category_id, fill_property_id, normalize
from tallyweave.operators.evaluation import TAG_TYPES, evaluate_script, evaluate_tags, sync_features, tag_texts
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

KEY = "itemKey"


def by_entity(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the documents with their key, spread by it before they become many rows.

    All steps of an entity then find its rows in one task.  The number of tasks is stated, as Spark would join
    them by the bytes they have at this point.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select(F.col("_key").alias(KEY), *columns).repartition(tasks, KEY)


def item_properties(docs: DataFrame, labels: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Property rows of the documents with ids and label scores."""
    flat = flatten_documents(by_entity(docs, "category", "doc"), ["category", KEY])
    rows = flat.distinct().select(
        "*",
        F.lit(None).cast("string").alias("categoryId"),
        F.lit(None).cast("string").alias("propertyId"),
        F.lit(None).cast(SCORE).alias("score"),
        F.lit(None).cast("int").alias("rank"),
        F.lit("pending").alias("status"),
        F.lit(1).alias("revision"),
    )
    rows = fill_category_id(rows, conf["mod_item_category"])
    rows = fill_property_id(rows, conf["mod_measure"])
    return normalize(rows, labels, ["category", "property", "value"])


def item_measures(docs: DataFrame, properties: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Scored measure tree of each item."""
    items = by_entity(docs, "category")
    mapping = conf["int_item_dimension_measure"].select(
        F.col("dimension_id").alias("dimension"), F.col("measure_id").alias("property"), "weight"
    )
    tasks = measure_tasks(items, conf["mod_item_dimension"], KEY, conf["mod_item_category"]).withColumn(
        "score", F.lit(None).cast(SCORE)
    )
    leaves = measure_by_property(tasks, mapping, properties, KEY)
    return measure_by_dimension(
        leaves, conf["mod_item_dimension"], conf["int_item_dimension_measure"], KEY
    )


def item_evaluations(
    docs: DataFrame, properties: DataFrame, measures: DataFrame, conf: dict[str, DataFrame]
) -> DataFrame:
    """Evaluations of each item: weighted, tags, scripts, then the tree above them."""
    items = by_entity(docs, "category")
    evals, eval_dims = conf["mod_item_evaluation"], conf["int_item_evaluation_dimension"]
    tasks = evaluate_tasks(items, evals, KEY, conf["mod_item_category"]).select(
        "*",
        F.lit(None).cast(SCORE).alias("score"),
        F.lit(None).cast("string").alias("text"),
        F.lit(True).alias("featured"),
    )
    mapping = evaluation_mapping(evals, eval_dims).select(
        F.col("evaluation_id").alias("evaluation"), "type", F.col("dimension_id").alias("dimension"), "weight"
    )
    rows = evaluate_weighted(tasks, mapping, measures, KEY, WEIGHTED_TYPES["item"])
    categories = conf["mod_item_category"]
    for kind, csv_col, tags in (
        ("motivation", "motivation_ids", conf["mod_motivation"]),
        ("occasion", "occasion_ids", conf["mod_occasion"]),
    ):
        types = [t for t, k in TAG_TYPES["item"].items() if k == kind]
        rows = evaluate_tags(rows, types, "category", tag_texts(categories, "id", csv_col, tags))
    scripted = evals.where(F.col("script").isNotNull())
    rows = evaluate_script(rows, properties, KEY, scripted, "item")
    leaf_ids = evals.join(evals.select(F.col("parent_id").alias("id")).distinct(), "id", "left_anti").select("id")
    mapped = eval_dims.select(F.col("evaluation_id").alias("id"))
    return evaluate_by_dimension(rows, evals, leaf_ids.union(mapped).distinct(), KEY)


def scored_items(docs: DataFrame, labels: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Documents to evaluations.

    Property rows feed the measures and the scripts, and measures are read by several
    evaluations, so both are written once in between.
    """
    properties = stage(item_properties(docs, labels, conf), "item-properties")
    measures = stage(item_measures(docs, properties, conf), "item-measures")
    return item_evaluations(docs, properties, measures, conf)


def scored_documents(docs: DataFrame, labels: DataFrame, conf: dict[str, DataFrame]) -> DataFrame:
    """Documents with their featured results, ready to be indexed."""
    return sync_features(docs, scored_items(docs, labels, conf), KEY)
