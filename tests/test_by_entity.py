"""Steps of one entity meet by its key alone, so rows that lie by entity are not moved again."""

import re
from decimal import Decimal

from pyspark.sql import functions as F

from tallyweave.operators import evaluation as ev
from tallyweave.operators import profile, scoring
from tallyweave.operators.upsert import update_from

TREE = "id string, parent_id string, weight decimal(6,3)"
EVALUATION = "itemKey string, evaluation string, type string, score decimal(18,6), text string, status string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_lie_by_entity_are_not_moved_again(spark, rows):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tree = spark.createDataFrame([("r", "0", Decimal(1)), ("a", "r", Decimal("0.5")), ("b", "r", Decimal("0.25"))], TREE)
    leaves = spark.createDataFrame([("a",), ("b",)], "id string")
    scores = (("r", None), ("a", Decimal(1)), ("b", Decimal(2)), ("a", Decimal(1)))
    keys = [f"i{n}" for n in range(2000)] + [None]
    listed = spark.createDataFrame([(k, n, "t", s, None, "pending") for k in keys for n, s in scores], EVALUATION)
    own = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "itemKey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20kb")  # the tree is broadcast, rows of entities are not
    try:
        rolled = scoring.roll_up(own, "evaluation", "itemKey", tree, leaves)
        assert "SortMergeJoin" in plan_of(rolled)
        assert not re.search(r"hashpartitioning\(itemKey#\d+, (?!\d+\)|\d+,)", plan_of(rolled)), plan_of(rolled)
        assert "hashpartitioning(evaluation" not in plan_of(rolled)
        got = rows(rolled, "itemKey", "evaluation", "score", "status")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    wanted = []
    for k in keys:
        wanted += [(k, "r", None if k is None else Decimal("1.500000"), "ready"), (k, "b", Decimal("2.000000"), "pending")]
        wanted += [(k, "a", Decimal("1.000000"), "pending")] * 2
    assert got == sorted(wanted, key=repr)


def test_only_leaves_below_a_node_are_carried_up(spark, rows, monkeypatch):
    tree = spark.createDataFrame(
        [("r", "0", Decimal(1)), ("a", "r", Decimal("0.5")), ("b", "r", Decimal("0.25")), ("top", "0", Decimal(1))], TREE
    )
    leaves = spark.createDataFrame([("a",), ("b",), ("top",)], "id string")
    scores = (("r", Decimal(5)), ("a", Decimal(1)), ("b", None), ("top", Decimal(3)), ("unknown", Decimal(4)), (None, Decimal(6)))
    own = spark.createDataFrame([("i", n, "t", s, None, "pending") for n, s in scores], EVALUATION)
    paths, _ = scoring.tree_paths(tree, leaves)
    assert sorted(scoring._listed(paths)) == ["a", "b"]
    listed = rows(scoring.roll_up(own, "evaluation", "itemKey", tree, leaves), "evaluation", "score", "status")
    monkeypatch.setattr(scoring, "LISTED", 1)
    assert scoring._listed(paths) is None
    assert rows(scoring.roll_up(own, "evaluation", "itemKey", tree, leaves), "evaluation", "score", "status") == listed
    assert ("r", Decimal("0.500000"), "ready") in listed and ("top", Decimal("3.000000"), "pending") in listed


def test_updates_that_meet_by_entity_are_those_of_the_keys(spark, rows):
    target = spark.createDataFrame(
        [(k, e, t, Decimal(9), None, "pending") for k in ("i", "j", None) for e, t in (("e", "x"), ("e", "x"), ("f", "x"), (None, "x"), ("e", None))],
        EVALUATION,
    )
    change = spark.createDataFrame(
        [("i", "e", "x", Decimal(1), "ready"), ("i", "f", "x", None, "ready"), ("i", None, "x", Decimal(3), "ready"), (None, "e", "x", Decimal(4), "ready")],
        "itemKey string, evaluation string, type string, score decimal(18,6), status string",
    )
    keys = ["itemKey", "evaluation", "type"]
    by_keys = update_from(target, change, keys, ["score", "status"])
    by_entity = update_from(target, change, keys, ["score", "status"], entity="itemKey")
    assert rows(by_entity, *target.columns) == rows(by_keys, *target.columns)
    assert by_entity.schema == by_keys.schema
    assert by_entity.where("status = 'ready'").count() == 3


def test_variables_in_columns_are_those_in_rows(spark, monkeypatch):
    properties = spark.createDataFrame(
        [("i", "a", "1", Decimal(1), 1), ("i", "a", "2", None, None), ("i", "b", None, None, None), ("j", "c", "x", None, 2), (None, "a", "n", None, 3)],
        "itemKey string, property string, value string, score decimal(18,6), rank int",
    )
    evaluations = spark.createDataFrame(
        [("i", "b", Decimal(7), "t"), ("k", "a", None, "only"), ("j", "z", Decimal(1), "unread")],
        "itemKey string, type string, score decimal(18,6), text string",
    )

    def taken(evals):
        out = profile.entity_profile(properties, evals, "itemKey", ["a", "b", "a", "absent"])
        return sorted(((r["itemKey"], sorted(r["p"].items())) for r in out.collect()), key=repr), out.schema

    in_columns = [taken(None), taken(evaluations)]
    plan = plan_of(profile.entity_profile(properties, evaluations, "itemKey", ["a", "b"]))
    monkeypatch.setattr(profile, "COLUMNS", 0)
    assert [taken(None), taken(evaluations)] == in_columns
    assert "collect_list" not in plan


def test_documents_are_parsed_once(spark, rows):
    docs = spark.createDataFrame(
        [("i", '{"b":1,"a":2}', "ready"), ("j", '{"b":1', "ready"), ("k", '{"z":1,"a":2}', "ready"), ("l", None, "ready")],
        "_key string, doc string, status string",
    )
    results = spark.createDataFrame(
        [(k, "e", "a", None, "new", "ready") for k in ("i", "j", "l")], EVALUATION
    ).withColumn("featured", F.lit(True))
    out = ev.sync_features(docs, results, "itemKey")
    assert rows(out, "_key", "doc", "status") == [
        ("i", '{"a":"new","b":1}', "pending"),
        ("j", '{"b":1', "ready"),
        ("k", '{"z":1,"a":2}', "ready"),
        ("l", None, "ready"),
    ]
    assert plan_of(out).count("parseJson(doc") == 1
