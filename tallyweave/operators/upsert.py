"""Keyed inserts and updates as new snapshots of a table.

The target may be far larger than the change.  Inserts first bring the change to one
row per key and write it down: it is computed once although it is read several
times, and its real size is known.  Where it is small Spark broadcasts it, and the
target is scanned but not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.sources.parts import BUCKETS, bucket_of, finish_rewrite, read_parts, rewrite_parts
from tallyweave.sources.tables import stage


# Moments of a row's insertion and last change, in tables that have such columns.
CREATED, MODIFIED = "createdOn", "modifiedOn"


def _moments(target: DataFrame, as_of: Column | None, *names: str) -> dict[str, Column]:
    stamp = F.current_timestamp() if as_of is None else as_of
    return {name: stamp for name in names if name in target.columns}


def one_row_per_key(rows: DataFrame, keys: list[str], count_as: str | None = None) -> DataFrame:
    """Keep the smallest row of each key, so reruns agree; optionally count the rows.

    The aggregate combines on the map side, so a hot key reaches the shuffle as one
    row per input task.
    """
    rest = [c for c in rows.columns if c not in keys]
    aggs = [F.min(F.struct(*rest)).alias("__row")] if rest else []
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    if not aggs:
        return rows.select(*keys).distinct()
    kept = rows.groupBy(*keys).agg(*aggs)
    columns = [F.col(k) for k in keys] + [F.col(f"__row.{c}").alias(c) for c in rest]
    return kept.select(*columns, *([count_as] if count_as else []))


def insert_ignore(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    defaults: dict[str, Column] | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Add the new rows whose key is not in the target yet; existing rows stay.

    ``defaults`` are columns all added rows have in common.  Where the target keeps the moments of
    insertion and change, added rows get ``as_of``, by default now.
    """
    fresh = stage(one_row_per_key(new, keys), "insert")
    common = {**_moments(target, as_of, CREATED, MODIFIED), **(defaults or {})}
    added = absent_from(fresh, target, keys).withColumns(common)
    return target.unionByName(added, allowMissingColumns=True)


def absent_from(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target lacks; a null in a key is a value like any other.

    The target is first cut to the keys at hand, so a large target is not shuffled
    for a small set of rows.  Where the rows are too many to be broadcast, Spark can drop most of the
    target at its scan by a Bloom filter of their keys; it builds one only of a side that looks
    selective, which the condition below, true of all keys, makes it.
    """
    wanted = rows.select(*keys).where(F.xxhash64(*keys) >= F.lit(-(2**63)))
    hit = _matching(target.select(*keys), wanted, keys, "left_semi")
    return _matching(rows, hit, keys, "left_anti")


def _matching(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys, nulls equal to nulls."""
    one, two = left.alias("l"), right.alias("r")
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    return one.join(two, reduce(Column.__and__, same), how)


def insert_or_bump_revision(
    target: DataFrame,
    new: DataFrame,
    keys: list[str],
    defaults: dict[str, Column] | None = None,
    first_revision: int = 1,
    as_of: Column | None = None,
) -> DataFrame:
    """Insert new keys; each further arrival of a key adds 1 to its revision.

    ``defaults`` are columns all added rows have in common.  Where the target keeps the moments of
    insertion and change, rows that are added or bumped get ``as_of``, by default now.
    """
    changed = _moments(target, as_of, MODIFIED)
    counted = stage(one_row_per_key(new.drop("revision"), keys, count_as="__n"), "upsert")
    seen = counted.select(*keys, F.col("__n").cast("int").alias("__n"))
    values = {
        "revision": F.col("revision") + F.coalesce(F.col("__n"), F.lit(0)),
        **{c: F.when(F.col("__n").isNotNull(), moment).otherwise(F.col(f"l.`{c}`")) for c, moment in changed.items()},
    }
    bumped = _matching(target, seen, keys, "left").select(
        *[values.get(c, F.col(f"l.`{c}`")).alias(c) for c in target.columns]
    )
    added = (
        absent_from(counted, target, keys)
        .withColumn("revision", (F.col("__n") + F.lit(first_revision - 1)).cast("int"))
        .withColumns({**_moments(target, as_of, CREATED, MODIFIED), **(defaults or {})})
        .drop("__n")
    )
    return bumped.unionByName(added, allowMissingColumns=True)


def bump_in_parts(
    spark: SparkSession,
    path: str,
    layout: T.StructType,
    new: DataFrame,
    keys: list[str],
    defaults: dict[str, Column] | None = None,
    first_revision: int = 1,
    buckets: int = BUCKETS,
) -> list[int]:
    """``insert_or_bump_revision`` on a table kept in ``bucket`` parts at ``path``; returns the parts rewritten.

    Parts without a key of ``new`` are neither read nor written, the others are read once and
    meet the change in one join.  ``layout`` is the table's, without the bucket;
    ``buckets`` is set by the first write.
    """
    finish_rewrite(spark, path, ["bucket"])
    table = read_parts(spark, path, T.StructType([*layout.fields, T.StructField("bucket", T.IntegerType())]))
    counted = one_row_per_key(new.drop("revision"), keys, count_as="__n").withColumns(defaults or {})
    fresh = stage(counted.withColumn("bucket", bucket_of(keys, buckets)), "upsert")
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
    if not touched:
        return []
    old = table.where(F.col("bucket").isin(touched)).withColumn("__old", F.lit(True)).alias("o")
    change = fresh.alias("f")
    same = F.col("o.bucket") == F.col("f.bucket")
    for key in keys:
        same = same & F.col(f"o.{key}").eqNullSafe(F.col(f"f.{key}"))
    joined = old.join(change, same, "full_outer")
    times = F.coalesce(F.col("f.__n"), F.lit(0))

    def value(field: T.StructField) -> Column:
        c = field.name
        own = F.col(f"o.{c}")
        if c == "revision":
            added = F.lit(first_revision - 1) + times
            return F.when(F.col("__old"), own + times).otherwise(added).cast(field.dataType).alias(c)
        other = F.col(f"f.{c}") if c in fresh.columns else F.lit(None)
        return F.when(F.col("__old"), own).otherwise(other).cast(field.dataType).alias(c)

    bucket = F.coalesce("o.bucket", "f.bucket").alias("bucket")
    rewrite_parts(joined.select(*[value(f) for f in layout.fields], bucket), path, ["bucket"])
    return touched


def meet_by_entity(target: DataFrame, change: DataFrame, entity: str, keys: list[str]) -> DataFrame:
    """``target`` and the ``__new`` of the row of ``change`` (``keys``, ``__new``) with its keys, null without one.

    The change of an entity travels as one map, so both sides meet by ``entity`` alone: a target that lies by
    entity stays where it is, and so do the steps after it that group or join by entity.  ``change`` must
    hold one row per key, and no more rows of an entity than a configuration has.
    """
    names = [k for k in keys if k != entity]
    name = F.col(names[0]) if len(names) == 1 else F.struct(*names)
    known = change.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    entries = F.collect_list(F.struct(name.alias("name"), "__new"))
    of_entity = known.groupBy(entity).agg(F.map_from_entries(entries).alias("__all"))
    return target.join(of_entity, entity, "left").withColumn("__new", F.col("__all")[name]).drop("__all")


def update_from(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    cols: list[str],
    also: dict[str, Column] | None = None,
    as_of: Column | None = None,
    entity: str | None = None,
) -> DataFrame:
    """Set ``cols`` of the target rows whose key is in ``updates``, nulls included.

    ``also`` holds further assignments for the matched rows, as expressions over the
    target's columns.  ``updates`` must hold one row per key.  Where the target keeps the moment
    of the last change, matched rows get ``as_of``, by default now.  ``entity`` names the key of ``keys``
    that both sides are to be joined by, see ``meet_by_entity``.
    """
    also = {**_moments(target, as_of, MODIFIED), **(also or {})}
    change = updates.select(*keys, F.struct(F.lit(True).alias("hit"), *cols).alias("__new"))
    joined = target.join(change, keys, "left") if entity is None else meet_by_entity(target, change, entity, keys)
    hit = F.col("__new").isNotNull()

    def value(c: str) -> Column:
        if c in cols:
            return F.when(hit, F.col(f"__new.{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
        if c in also:
            return F.when(hit, also[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
        return F.col(c)

    return joined.select(*[value(c) for c in target.columns])
