"""Weighted scores of leaf nodes and their roll-up through weighted trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.upsert import meet_by_entity, one_row_per_key, update_from
from tallyweave.sources.tables import stage


def _sum_of(weight: str, score: str, like: DataFrame) -> Column:
    return F.sum(F.col(weight) * F.col(score)).cast(like.schema["score"].dataType).alias("score")


def measure_by_property(
    measure: DataFrame, mapping: DataFrame, property_: DataFrame, key: str
) -> DataFrame:
    """Score of the mapped dimensions: sum of weight times score of their properties.

    ``mapping`` holds (dimension, property, weight): either the configuration, which
    Spark broadcasts by its size, or the tasks of each entity, which then carry
    ``key`` and are joined by it.  Mapped dimensions become ready, with a null score
    where no property is scored.
    """
    by = ([key] if key in mapping.columns else []) + ["property"]
    scored = property_.where(F.col("score").isNotNull() & F.col("propertyId").isNotNull()).select(
        key, F.col("propertyId").alias("property"), "score"
    )
    rules = mapping.select(*by, "dimension", F.col("weight").alias("__w"))
    sums = scored.join(rules, by).groupBy(key, "dimension").agg(_sum_of("__w", "score", measure))
    mapped_by = ([key] if key in mapping.columns else []) + ["dimension"]
    leaf = mapping.select(*mapped_by).distinct().withColumn("__hit", F.lit(True))
    return _scored(measure, _with_sums(measure, sums, key, "dimension").join(leaf, mapped_by, "left"))


def _with_sums(rows: DataFrame, sums: DataFrame, key: str, node: str) -> DataFrame:
    """``rows`` with the sum of their entity and node as ``score`` and their own score as ``__old``."""
    change = sums.select(key, node, F.struct("score").alias("__new"))
    met = meet_by_entity(rows.withColumnRenamed("score", "__old"), change, key, [key, node])
    return met.withColumn("score", F.col("__new.score")).drop("__new")


def _scored(target: DataFrame, joined: DataFrame) -> DataFrame:
    hit = F.col("__hit").isNotNull()
    columns = {
        "score": F.when(hit, F.col("score")).otherwise(F.col("__old")).alias("score"),
        "status": F.when(hit, F.lit("ready")).otherwise(F.col("status")).alias("status"),
    }
    return joined.select(*[columns.get(c, F.col(c)) for c in target.columns])


def tree_paths(tree: DataFrame, leaf_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (node, ancestor, weight) of the leaves and ids of the inner nodes of a configured tree.

    ``tree`` is (id, parent_id, weight) with one row per id; weights are multiplied along the
    path.  A node with scores of its own is a leaf even when it has children, so nothing is
    carried through it.

    Trees of any size and depth are climbed alike: each round doubles the distance that the
    inner nodes can look up and thereby the length of the leaves' paths, so a tree of depth d
    takes log2(d) rounds of two joins.  What the nodes look up to is a table per round in
    the shared folder.  Pointers that are still left when they would be longer than the tree
    has nodes run in a circle, which is refused, as are repeated ids.
    """
    own = leaf_ids.toDF("id").distinct().withColumn("leaf", F.lit(True))
    product = "decimal(20,12)" if dict(tree.dtypes)["weight"].startswith("decimal") else "double"
    listed = tree.select("id", F.col("parent_id").alias("up"), F.col("weight").cast(product).alias("w"))
    nodes = stage(listed.join(own, "id", "left"), "tree")
    total, distinct = nodes.agg(F.count("id"), F.count_distinct("id")).first()
    if total != distinct:
        raise ValueError("an id stands for several nodes of the tree")
    inner = nodes.where(F.col("leaf").isNull()).select("id")
    inside = inner.withColumnRenamed("id", "up")
    steps = stage(nodes.where(F.col("leaf").isNull()).join(inside, "up", "left_semi").select("id", "up", "w"), "tree-steps")
    paths = nodes.where("leaf").join(inside, "up", "left_semi").select(
        F.col("id").alias("node"), F.col("up").alias("ancestor"), F.col("w").alias("weight")
    )
    reach = 1
    while not steps.isEmpty():
        if reach > total:
            raise ValueError("the tree runs in a circle")
        jump = steps.select(F.col("id").alias("ancestor"), F.col("up").alias("__up"), F.col("w").alias("__w"))
        longer = F.struct("node", F.col("__up").alias("ancestor"), (F.col("weight") * F.col("__w")).cast(product).alias("weight"))
        both = F.array(F.struct("node", "ancestor", "weight"), F.when(F.col("__up").isNotNull(), longer))
        paths = paths.join(jump, "ancestor", "left").select(F.inline(F.array_compact(both)))
        second = steps.select(F.col("id").alias("up"), F.col("up").alias("__up"), F.col("w").alias("__w"))
        steps = stage(
            steps.join(second, "up").select("id", F.col("__up").alias("up"), (F.col("w") * F.col("__w")).cast(product).alias("w")),
            "tree-steps",
        )
        reach *= 2
    return paths.where(F.col("weight").isNotNull()), inner


#: leaves that a plan lists by name
LISTED = 1000


def _listed(paths: DataFrame) -> list | None:
    """The leaves that add to some node, where they are few enough to be a condition.

    The join with the paths leaves out all others as well, but Spark takes a condition below the joins that gave
    the rows their scores, and a join not.
    """
    found = [r["node"] for r in paths.select("node").distinct().limit(LISTED + 1).collect()]
    return found if len(found) <= LISTED else None


def roll_up(rows: DataFrame, node: str, key: str, tree: DataFrame, leaf_ids: DataFrame) -> DataFrame:
    """Score of the inner nodes: weighted sum over children, deepest level first.

    Done in one grouping: each scored leaf adds its path weight times its score to
    every ancestor.  Unscored children add nothing; a node with no scored leaf below
    becomes ready with a null score.
    """
    paths, inner = tree_paths(tree, leaf_ids)
    carried = paths.select(F.col("node").alias(node), "ancestor", F.col("weight").alias("__w"))
    below = _listed(paths)
    scored = rows if below is None else rows.where(F.col(node).isin(below))
    scored = scored.where(F.col("score").isNotNull()).select(key, node, "score")
    sums = (
        scored.join(carried, node)
        .groupBy(key, F.col("ancestor").alias(node))
        .agg(_sum_of("__w", "score", rows))
    )
    flags = inner.select(F.col("id").alias(node), F.lit(True).alias("__hit"))
    return _scored(rows, _with_sums(rows, sums, key, node).join(flags, node, "left"))


def roll_up_changes(
    rows: DataFrame, node: str, key: str, changed: DataFrame, paths: DataFrame, inner: DataFrame
) -> DataFrame:
    """What new scores of leaves alter in ``rows``: the leaves and the nodes above them, as they are then.

    ``changed`` holds (key, node, score), nulls included; ``rows`` are rolled up already, all
    rows of the changed entities at least.  Nodes above a change are summed anew over
    the stored ``paths`` (of ``tree_paths``), so the result is what ``roll_up`` of all rows would
    give them, to the last digit.  No other entity and no other node is grouped.
    """
    fresh = stage(one_row_per_key(changed.select(key, node, F.col("score").alias("__new")), [key, node]), "changed-leaves")
    carried = paths.select(F.col("node").alias(node), "ancestor", F.col("weight").alias("__w"))
    above = fresh.join(carried, node).select(key, F.col("ancestor").alias(node)).distinct()
    marks = fresh.withColumn("__leaf", F.lit(True)).unionByName(above, allowMissingColumns=True)
    own = rows.join(fresh.select(key).distinct(), key, "left_semi").join(marks.withColumn("__hit", F.lit(True)), [key, node], "left")
    score = F.when(F.col("__leaf"), F.col("__new")).otherwise(F.col("score")).cast(rows.schema["score"].dataType)
    own = stage(own.withColumn("score", score), "changed-entities")
    altered = own.where("__hit")
    sums = (
        own.where(F.col("score").isNotNull())
        .select(key, node, "score")
        .join(carried, node)
        .select(key, F.col("ancestor").alias(node), "__w", "score")
        .join(above, [key, node], "left_semi")
        .groupBy(key, node)
        .agg(_sum_of("__w", "score", rows))
    )
    summed = altered.where("__leaf IS NULL").join(inner.select(F.col("id").alias(node)), node, "left_semi")
    summed = summed.drop("score").join(sums, [key, node], "left")
    done = summed.select(*rows.columns).unionByName(altered.where("__leaf").select(*rows.columns))
    return done.withColumn("status", F.lit("ready"))


def measure_by_dimension(measure: DataFrame, dims: DataFrame, dim_measures: DataFrame, key: str) -> DataFrame:
    """Roll the measured dimensions up their tree."""
    return roll_up(measure, "dimension", key, dims, dim_measures.select("dimension_id"))


def evaluate_by_dimension(evaluation: DataFrame, evals: DataFrame, leaf_ids: DataFrame, key: str) -> DataFrame:
    """Roll the scored evaluations up their tree."""
    return roll_up(evaluation, "evaluation", key, evals, leaf_ids)


# Fixed values.
WEIGHTED_TYPES = {
    "item": ["a", "b", "c", "d", "e", "x", "y", "z"],
    "user": ["perform", "economy", "culture", "society"],
}


def evaluate_weighted(
    evaluation: DataFrame, evaluation_measure: DataFrame, measure: DataFrame, key: str, types: list[str]
) -> DataFrame:
    """Evaluations of the weighted types: sum of weight times measure score of the same entity.

    ``evaluation_measure`` is the configured (evaluation, type, dimension, weight), or
    the tasks of each entity, which carry ``key``.  Without any scored measure the
    evaluation stays as it is.
    """
    by = ([key] if key in evaluation_measure.columns else []) + ["dimension"]
    rules = evaluation_measure.where(F.lower("type").isin(types)).select(
        *by, "evaluation", "type", F.col("weight").alias("__w")
    )
    scored = measure.where(F.col("score").isNotNull()).select(key, "dimension", "score")
    sums = (
        scored.join(rules, by)
        .groupBy(key, "evaluation", "type")
        .agg(_sum_of("__w", "score", evaluation))
        .withColumn("status", F.lit("ready"))
    )
    return update_from(evaluation, sums, [key, "evaluation", "type"], ["score", "status"], entity=key)
