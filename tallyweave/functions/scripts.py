"""Configured scoring scripts as Catalyst expressions.

A script is a Spark SQL scalar expression over the variable map ``p``, for example
``p['account.balance'].score * 2``.  Scripts are configuration: they are read on
the driver within a checked number and become ``CASE`` branches of one projection,
so evaluation stays inside the executors' generated code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import folder_exists, shared_folder

VARIABLES = "p"
VARIABLE_TYPE = "struct<var:string,value:string,score:double,rank:int,text:string>"
MAX_SCRIPTS = 5000
_CASE_BRANCHES = 100
_CHECKED = 1000
#: scripts that one projection holds; with more, rows are dealt out by groups of scripts
GROUP = 400
_TEXT = r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*\""""
# p['x'], p["x"], p.x, p.`x`, element_at(p, 'x')
_ACCESS = re.compile(
    rf"""\bp\s*\[\s*(?P<bracket>{_TEXT})\s*\]
       | \b(?:try_)?element_at\s*\(\s*p\s*,\s*(?P<call>{_TEXT})\s*\)
       | \bp\s*\.\s*(?:`(?P<tick>(?:[^`]|``)+)`|(?P<dot>\w+))""",
    re.IGNORECASE | re.VERBOSE,
)
_QUOTED = re.compile(_TEXT)
_BARE = re.compile(r"\bp\b", re.IGNORECASE)
_SUBQUERY = re.compile(r"\b(select|values|table)\b", re.IGNORECASE)


def read_scripts(config: DataFrame, id_col: str, script_col: str, limit: int = MAX_SCRIPTS) -> dict[str, str]:
    """The configured scripts by id; fails when there are more than ``limit``."""
    rows = (
        config.where(F.col(script_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(script_col).alias("script"))
        .limit(limit + 1)
        .collect()
    )
    if len(rows) > limit:
        raise ValueError(f"more than {limit} scripts are configured; raise the limit or split the configuration")
    scripts = {r["id"]: r["script"] for r in sorted(rows, key=lambda r: r["id"])}
    texts = sorted(set(scripts.values()))
    for start in range(0, len(texts), _CHECKED):
        check_scripts(config, texts[start : start + _CHECKED])
    return scripts


def check_scripts(frame: DataFrame, scripts: Iterable[str]) -> None:
    """Reject whatever is not a scalar, deterministic expression over named variables.

    Analysis of a join condition refuses aggregates, windows, generators and whatever may
    differ from run to run, which calls into other code count as; subqueries are refused by
    their keywords outside quotes, variables with a computed name by ``variables_of``.
    """
    scripts = list(scripts)
    for script in scripts:
        if _SUBQUERY.search(_QUOTED.sub("''", script)):
            raise ValueError(f"a script must be a scalar expression: {script}")
    variables_of(scripts)
    spark = frame.sparkSession
    probe = spark.createDataFrame([], f"{VARIABLES} map<string,{VARIABLE_TYPE}>")
    results = F.greatest(F.lit(""), F.lit(""), *[F.expr(s).cast("string") for s in scripts])
    probe.join(spark.createDataFrame([], "other int"), results == "").schema


def variables_of(scripts: Iterable[str]) -> list[str]:
    """Names of the variables that the scripts read, however the name is spelled.

    A variable is read by a literal name; ``p`` in any other place is an error, as what it
    would read cannot be known beforehand.
    """
    found: set[str] = set()
    for script in scripts:
        for m in _ACCESS.finditer(script):
            quoted = m["bracket"] or m["call"]
            if quoted:
                mark = quoted[0]
                found.add(re.sub(r"\\(.)", r"\1", quoted[1:-1].replace(mark * 2, mark)))
            else:
                found.add(m["tick"].replace("``", "`") if m["tick"] else m["dot"])
        if _BARE.search(_QUOTED.sub("''", _ACCESS.sub("NULL", script))):
            raise ValueError(f"a script must read variables by literal names: {script}")
    return sorted(found)


def script_text(id_col: str, scripts: dict[str, str]) -> Column:
    """Text result of the script that belongs to the column ``id_col``; null without one.

    Written as one SQL text, which the JVM parses in one go however many branches it has.
    """
    ids = list(scripts)
    cases = []
    for start in range(0, len(ids), _CASE_BRANCHES):
        branches = [f"WHEN {_literal(i)} THEN CAST(({scripts[i]}) AS STRING)" for i in ids[start : start + _CASE_BRANCHES]]
        cases.append(f"CASE {id_col} {' '.join(branches)} END")
    return F.expr(f"coalesce({', '.join(cases)})") if cases else F.lit(None).cast("string")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_script_texts(rows: DataFrame, wanted: dict[str, tuple[Column, dict[str, str]]]) -> DataFrame:
    """``rows`` and, by name, the text results of the scripts that (id column, scripts) names.

    Up to ``GROUP`` scripts are branches of one projection.  More of them would no longer run
    as generated code, and every row would try thousands of branches: then the rows are
    written down by group of scripts, and each group is read with its own projection.
    """
    for name, (id_col, scripts) in wanted.items():
        if len(scripts) <= GROUP:
            # the id is a column of its own: every branch looks at it
            named = rows.withColumn(f"{name}_id", id_col)
            rows = named.withColumn(name, script_text(f"{name}_id", scripts)).drop(f"{name}_id")
        else:
            rows = _by_groups(rows, id_col, scripts, name)
    return rows


def _by_groups(rows: DataFrame, id_col: Column, scripts: dict[str, str], name: str) -> DataFrame:
    spark = rows.sparkSession
    ids = list(scripts)
    groups = [ids[at : at + GROUP] for at in range(0, len(ids), GROUP)]
    listed = spark.createDataFrame([(i, g) for g, own in enumerate(groups) for i in own], "__id string, __group int")
    placed = rows.withColumn("__id", id_col).join(listed, "__id", "left")
    placed = placed.withColumn("__group", F.coalesce("__group", F.lit(-1)))
    path = shared_folder(spark, "scripted")
    placed.hint("rebalance", "__group").write.partitionBy("__group").parquet(path)
    layout = placed.drop("__group").schema
    parts = []
    for g, own in [(-1, []), *enumerate(groups)]:
        if folder_exists(spark, f"{path}/__group={g}"):
            part = spark.read.schema(layout).parquet(f"{path}/__group={g}")
            text = script_text("__id", {i: scripts[i] for i in own})
            parts.append(part.select(*rows.columns, text.alias(name)))
    if not parts:
        return rows.withColumn(name, F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, parts)


def text_to_score(text: Column) -> Column:
    """A script result as a number: true is 1, false is 0, other text must parse."""
    return F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))
