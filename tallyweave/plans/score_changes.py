"""Changed scores carried up their trees, in tables kept by entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.operators.scoring import roll_up_changes, tree_paths
from tallyweave.operators.upsert import update_from
from tallyweave.sources.parts import BUCKETS, bucket_of, finish_rewrite, read_parts, rewrite_parts
from tallyweave.sources.tables import stage


def by_entity(rows: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows with the ``bucket`` of their entity, for ``add_to_parts``."""
    return rows.withColumn("bucket", bucket_of([key], buckets))


def change_scores(
    spark: SparkSession,
    path: str,
    layout: T.StructType,
    changed: DataFrame,
    node: str,
    key: str,
    tree: DataFrame,
    leaf_ids: DataFrame,
    buckets: int = BUCKETS,
) -> list[int]:
    """Set new scores of leaves and all scores above them; returns the buckets that were rewritten.

    The table at ``path`` was written by ``by_entity`` with as many ``buckets`` and is rolled up.  Only
    buckets that hold a changed entity are read and rewritten, the others keep their files.
    """
    finish_rewrite(spark, path, ["bucket"])
    changes = stage(changed.select(key, node, "score", bucket_of([key], buckets).alias("bucket")), "changed-scores")
    touched = sorted(r["bucket"] for r in changes.select("bucket").distinct().collect())
    if not touched:
        return []
    kept = read_parts(spark, path, T.StructType([*layout.fields, T.StructField("bucket", T.IntegerType())]))
    rows = kept.where(F.col("bucket").isin(touched))
    paths, inner = tree_paths(tree, leaf_ids)
    altered = stage(roll_up_changes(rows.drop("bucket"), node, key, changes.drop("bucket"), paths, inner), "altered-scores")
    rewrite_parts(update_from(rows, altered, [key, node], ["score", "status"]), path, ["bucket"])
    return touched
