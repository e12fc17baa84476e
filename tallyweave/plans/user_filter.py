"""User profiles to personas and search filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.operators.filters import bool_clauses, cost_decay, function_score, persona_decay
from tallyweave.operators.persona import best_persona, score_personas
from tallyweave.operators.upsert import update_from
from tallyweave.sources.tables import stage


def matched_personas(
    user_persona: DataFrame, property_: DataFrame, evaluation: DataFrame, conf: dict[str, DataFrame]
) -> DataFrame:
    """All three persona scores over one profile."""
    return score_personas(
        user_persona,
        property_,
        evaluation,
        {
            "scoreHierarchy": (conf["mod_hierarchy"], "expression", "hierarchyId"),
            "scorePhase": (conf["mod_phase"], "expression", "phaseId"),
            "scorePersona": (conf["mod_persona"], "expression", "personaId"),
        },
    )


def user_filters(
    users: DataFrame,
    user_persona: DataFrame,
    user_query: DataFrame,
    property_: DataFrame,
    evaluation: DataFrame,
    conf: dict[str, DataFrame],
    every: bool = False,
) -> DataFrame:
    """The search query of each of ``users``, from scored personas on.

    Everything is cut to the users at hand before it is grouped.  Where ``users`` are stated to be
    ``every`` user of the tables, there is nothing to cut: rows are then grouped as they are read, and
    reach the shuffle as one per user.
    """
    asked = users.select("userKey").distinct()

    def of_users(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("userKey").isNotNull()) if every else rows.join(asked, "userKey", "left_semi")

    evaluated = of_users(evaluation)
    personas = best_persona(matched_personas(of_users(user_persona), of_users(property_), evaluated, conf))
    return function_score(
        users, bool_clauses(of_users(user_query)), persona_decay(personas, conf["mod_persona"]), cost_decay(evaluated)
    )


def filter_documents(docs: DataFrame, filters: DataFrame) -> DataFrame:
    """User documents with the new search queries of ``filters`` (userKey, query) in ``query``."""
    return update_from(docs, filters.select(F.col("userKey").alias("_key"), "query"), ["_key"], ["query"])


def user_digests(tables: dict[str, DataFrame], conf: dict[str, DataFrame]) -> DataFrame:
    """(userKey, digest): what all rows of a user in ``tables``, in any order, and the configuration look like.

    Kept from one run to the next, it says whose rows have changed.  Rows meet as partial
    sums, so a user with any number of rows is one row per input task.
    """
    settings = [
        rows.agg(F.count(F.lit(1)), *_sums(*_hashes(name, rows))).select(F.struct("*").alias("s")).first()["s"]
        for name, rows in sorted(conf.items())
    ]
    rows = [t.select("userKey", *_hashes(name, t)) for name, t in sorted(tables.items())]
    digest = F.struct(F.count(F.lit(1)).alias("rows"), *_sums(F.col("one"), F.col("two")))
    every = reduce(DataFrame.unionByName, rows).groupBy("userKey").agg(digest.alias("rows"))
    return every.select("userKey", F.md5(F.concat_ws("|", F.to_json("rows"), F.lit(str(settings)))).alias("digest"))


def _hashes(name: str, rows: DataFrame) -> list[Column]:
    # two hashes that have nothing to do with one another; nulls and absent values differ by their place
    fields = sorted(rows.schema.fields, key=lambda f: f.name)
    values = [v for f in fields for v in (F.col(f"`{f.name}`").isNull(), _hashed(f))]
    label = F.lit(" ".join([name, *(f"{f.name}:{f.dataType.simpleString()}" for f in fields)]))
    two = F.xxhash64(F.hash(label, *values), *reversed(values), label)
    return [F.xxhash64(label, *values).alias("one"), two.alias("two")]


def _hashed(field: T.StructField) -> Column:
    # what is nested keeps its nulls in JSON; fractions as text tell 0.0 from -0.0
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    return c.cast("string") if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else c


def _sums(one: Column, two: Column) -> list[Column]:
    # the halves of a hash are summed as longs, which 2^31 rows do not fill
    halves = F.sum(F.shiftright(one, 32)).alias("high"), F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")
    return [*halves, F.bit_xor(two).alias("two")]


def changed_users(last: DataFrame | None, now: DataFrame) -> DataFrame:
    """(userKey): users whose digest is not what it was, new and vanished ones included; all without ``last``."""
    if last is None:
        return now.select("userKey")
    before = last.select("userKey", F.col("digest").alias("__before"))
    both = now.join(before, "userKey", "full_outer")
    return both.where(~F.col("digest").eqNullSafe(F.col("__before"))).select("userKey")


def changed_user_filters(
    docs: DataFrame,
    last: DataFrame | None,
    user_persona: DataFrame,
    user_query: DataFrame,
    property_: DataFrame,
    evaluation: DataFrame,
    conf: dict[str, DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """(documents, digests) after a run: filters are built for users whose rows have changed, and for no others.

    ``last`` are the digests of the run before; keep the new ones for the next.  Documents of
    all other users keep their row.
    """
    tables = {"persona": user_persona, "query": user_query, "property": property_, "evaluation": evaluation}
    now = stage(user_digests(tables, conf), "user-digests")
    asked = stage(changed_users(last, now), "changed-users")
    filters = user_filters(asked, user_persona, user_query, property_, evaluation, conf, every=last is None)
    return filter_documents(docs, filters), now
