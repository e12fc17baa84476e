"""Variables of an entity, as scripts see them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.scripts import VARIABLE_TYPE, VARIABLES

# so many variables are columns of one grouping, more are rows of it
COLUMNS = 32


def profile_rows(property_: DataFrame, evaluation: DataFrame | None, key: str) -> DataFrame:
    """One row per entity and variable: (key, name, var, value, score, rank, text).

    Properties give ``value``, ``score`` and ``rank``; evaluations give ``score`` and
    ``text`` and take over the plain variable ``var``.  Of several values of a
    property, and of several evaluations of a type, the greatest is kept.
    """
    props = property_.select(
        key,
        F.col("property").alias("name"),
        F.struct("value", "score", "rank").alias("__p"),
        F.lit(None).cast(_evaluated_type(evaluation)).alias("__e"),
    )
    if evaluation is not None:
        evals = evaluation.select(
            key,
            F.col("type").alias("name"),
            F.lit(None).cast(props.schema["__p"].dataType).alias("__p"),
            F.struct("score", "text").alias("__e"),
        )
        props = props.unionByName(evals)
    kept = props.groupBy(key, "name").agg(F.max("__p").alias("__p"), F.max("__e").alias("__e"))
    return kept.select(key, "name", *_fields(F.col("__p"), F.col("__e")))


def _evaluated_type(evaluation: DataFrame | None):
    if evaluation is None:
        return "struct<score:double,text:string>"
    return evaluation.select(F.struct("score", "text").alias("e")).schema["e"].dataType


def _fields(p: Column, e: Column) -> list[Column]:
    evaluated = e.isNotNull()
    return [
        F.when(evaluated, e["score"].cast("double").cast("string")).otherwise(p["value"]).alias("var"),
        p["value"].alias("value"),
        F.when(evaluated, e["score"]).otherwise(p["score"]).alias("score"),
        p["rank"].alias("rank"),
        e["text"].alias("text"),
    ]


def entity_profile(
    property_: DataFrame, evaluation: DataFrame | None, key: str, names: list[str]
) -> DataFrame:
    """(key, p): the named variables of each entity as a map, for entities that have any.

    Only the variables that scripts read are kept: the filter on names reaches the scan.
    Of an entity with any number of rows at most the greatest of each name is held: in a column per name, or where
    there are more names than ``COLUMNS``, in rows that are put together once each name has one.
    """
    rows = property_.where(F.col("property").isin(names)).select(
        key,
        F.col("property").alias("name"),
        F.struct("value", "score", "rank").alias("__p"),
        F.lit(None).cast(_evaluated_type(evaluation)).alias("__e"),
    )
    if evaluation is not None:
        rows = rows.unionByName(
            evaluation.where(F.col("type").isin(names)).select(
                key,
                F.col("type").alias("name"),
                F.lit(None).cast(rows.schema["__p"].dataType).alias("__p"),
                F.struct("score", "text").alias("__e"),
            )
        )
    if 0 < len(names) <= COLUMNS:
        return _pivoted(rows, key, sorted(set(names)), evaluation is not None)
    kept = rows.groupBy(key, "name").agg(F.max("__p").alias("__p"), F.max("__e").alias("__e"))
    value = F.struct(*_fields(F.col("__p"), F.col("__e"))).cast(VARIABLE_TYPE)
    return kept.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("name", value.alias("value")))).alias(VARIABLES)
    )


def _pivoted(rows: DataFrame, key: str, names: list[str], evaluated: bool) -> DataFrame:
    kinds = ["__p", "__e"] if evaluated else ["__p"]
    greatest = [F.max(F.when(F.col("name") == n, F.col(k))).alias(f"{k}{i}") for i, n in enumerate(names) for k in kinds]
    none = F.lit(None).cast(rows.schema["__e"].dataType)
    entries = []
    for i, name in enumerate(names):
        p, e = F.col(f"__p{i}"), F.col(f"__e{i}") if evaluated else none
        value = F.struct(*_fields(p, e)).cast(VARIABLE_TYPE)
        entries.append(F.when(p.isNotNull() | e.isNotNull(), F.struct(F.lit(name).alias("name"), value.alias("value"))))
    held = F.map_from_entries(F.array_compact(F.array(*entries)))
    return rows.groupBy(key).agg(*greatest).select(key, held.alias(VARIABLES))
