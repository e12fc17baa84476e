"""Runs that follow what has changed: roll-ups, filters, inserts, and scripts in great number."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from suite.registry import Tables
from tallyweave.functions import scripts
from tallyweave.operators import persona, scoring
from tallyweave.operators.upsert import absent_from, insert_ignore
from tallyweave.plans import score_changes
from tallyweave.plans.load import load_entities
from tallyweave.plans.user_filter import changed_user_filters, changed_users, filter_documents, user_digests, user_filters
from tallyweave.schemas import table_schema
from tallyweave.sources.parts import add_to_parts

SF_DIR = "/root/testdata/sf0.001"
TREE = "id string, parent_id string, weight decimal(6,3)"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_changed_scores_read_and_write_their_buckets_only(spark, rows, tmp_path):
    path = str(tmp_path / "m")
    tree = spark.createDataFrame([("r", "0", Decimal(1)), ("a", "r", Decimal("0.5")), ("b", "r", Decimal("0.3")), ("a1", "a", Decimal("0.7"))], TREE)
    leaf_ids = spark.createDataFrame([("a1",), ("b",)], "id string")
    users = [(f"u{i}", "", d, None, Decimal(i % 7) if d in ("a1", "b") else None, "pending", 1, 1) for i in range(60) for d in ("r", "a", "b", "a1")]
    layout = table_schema("user_measure")
    rolled = scoring.roll_up(spark.createDataFrame(users, layout), "dimension", "userKey", tree, leaf_ids)
    add_to_parts(score_changes.by_entity(rolled, "userKey", 16), path, ["bucket"])
    before = files(path)
    changed = spark.createDataFrame([("u3", "a1", Decimal("9.333333")), ("u3", "b", None), ("u5", "b", None), ("u5", "a1", None), ("nobody", "b", Decimal(1))], "userKey string, dimension string, score decimal(18,6)")
    touched = score_changes.change_scores(spark, path, rolled.schema, changed, "dimension", "userKey", tree, leaf_ids, 16)
    stayed = {f for f in before if not any(f"bucket={b}{os.sep}" in f for b in touched)}
    assert len(touched) <= 3 and stayed and stayed <= files(path)
    found = spark.read.schema(rolled.schema).parquet(path).drop("bucket")
    scores = {(r["userKey"], r["dimension"]): r["score"] for r in found.where("userKey IN ('u3', 'u5', 'u4')").collect()}
    assert scores[("u3", "a")] == Decimal("6.533333") and scores[("u3", "r")] == Decimal("3.266667")
    assert scores[("u3", "b")] is None and scores[("u5", "r")] is None and scores[("u5", "a1")] is None
    assert scores[("u4", "r")] == Decimal("2.600000")
    fresh = rolled.join(changed.withColumnRenamed("score", "new").withColumn("hit", F.lit(True)), ["userKey", "dimension"], "left")
    fresh = fresh.withColumn("score", F.when(F.col("hit"), F.col("new")).otherwise(F.col("score"))).select(*rolled.columns)
    whole = scoring.roll_up(fresh, "dimension", "userKey", tree, leaf_ids)
    assert rows(found, "userKey", "dimension", "score") == rows(whole, "userKey", "dimension", "score")
    assert score_changes.change_scores(spark, path, rolled.schema, changed.limit(0), "dimension", "userKey", tree, leaf_ids, 16) == []


def test_only_changed_users_are_asked_again(spark, rows):
    t = Tables(spark, SF_DIR)
    conf = t.some("mod_hierarchy", "mod_phase", "mod_persona")
    now = [t["user_persona"], t["user_query"], t["user_property"], t["user_evaluation"]]
    names = ["persona", "query", "property", "evaluation"]
    last = user_digests(dict(zip(names, now)), conf)
    assert last.count() == last.select("userKey").distinct().count()
    # the same rows in another order are the same; one row more, one value other, one user gone are not
    again = user_digests({n: f.repartition(5) for n, f in zip(names, now)}, conf)
    assert changed_users(last, again).collect() == []
    queries = t["user_query"].withColumn("text", F.when(F.col("userKey") == "3", F.lit("other")).otherwise(F.col("text")))
    queries = queries.unionByName(t["user_query"].where("userKey = '5'").limit(1)).where("userKey <> '8'")
    evaluations = t["user_evaluation"].where("userKey <> '8'")
    changed = [t["user_persona"].where("userKey <> '8'"), queries, t["user_property"].where("userKey <> '8'"), evaluations]
    assert rows(changed_users(last, user_digests(dict(zip(names, changed)), conf)), "userKey") == [("3",), ("5",), ("8",)]
    # a sentinel in a document that need not be made again stays
    docs = t["user_docs"].withColumn("query", F.lit("as it was"))
    after, _ = changed_user_filters(docs, last, *changed, conf)
    made = {r["_key"] for r in after.where("query <> 'as it was'").collect()}
    assert made == {"3", "5", "8"}
    # other configuration: all of them
    other = conf | {"mod_persona": conf["mod_persona"].withColumn("alpha", F.lit("0.9"))}
    assert changed_users(last, user_digests(dict(zip(names, now)), other)).count() == last.count()


def test_a_first_run_asks_all_users_without_looking_them_up(spark, rows):
    t = Tables(spark, SF_DIR)
    conf = t.some("mod_hierarchy", "mod_phase", "mod_persona")
    nobody = t["user_query"].limit(1).withColumn("userKey", F.lit(None).cast("string"))
    now = [t["user_persona"], t["user_query"].unionByName(nobody), t["user_property"], t["user_evaluation"]]
    first, digests = changed_user_filters(t["user_docs"], None, *now, conf)
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan
    users = digests.select("userKey")
    looked_up = filter_documents(t["user_docs"], user_filters(users, *now, conf))
    assert rows(first, *first.columns) == rows(looked_up, *first.columns)


def test_digests_tell_values_apart_without_writing_json(spark):
    layout = "userKey string, a string, b string, d double, l array<string>"
    kinds = [("x", None, 0.0, ["y", None]), (None, "x", 0.0, ["y", None]), ("", "x", 0.0, ["y", None]), ("x", None, -0.0, ["y", None]),
             ("x", None, None, ["y", None]), ("x", None, 0.0, ["y"]), ("x", None, 0.0, None), ("x", "x", 0.0, ["y", None])]
    table = spark.createDataFrame([(str(i), *k) for i, k in enumerate(kinds)], layout)
    conf = {"c": spark.createDataFrame([("1", 0.5)], "id string, alpha double")}

    def of(rows):
        # all rows under one user, as the key is part of a row
        return [user_digests({"t": rows.where(F.col("userKey") == str(i)).withColumn("userKey", F.lit("u"))}, conf).first()["digest"] for i in range(len(kinds))]

    found = of(table)
    assert len(set(found)) == len(kinds)
    # a repeated row is seen, the name of a column and of a table too
    one = table.where("userKey = '0'")
    twice = {n: user_digests({n: f}, conf).first()["digest"] for n, f in (("t", one.union(one)), ("s", one), ("r", one.withColumnRenamed("a", "z")))}
    plain = user_digests({"t": one}, conf).first()["digest"]
    assert len({plain, *twice.values()}) == 4
    flat = user_digests({"t": table.drop("l")}, conf)._jdf.queryExecution().optimizedPlan().toString()
    assert flat.count("StructsToJsonEvaluator") == 1, "the sums of a user are JSON, not its rows"


@pytest.fixture
def setting(spark):
    old = {}

    def put(name, value):
        old.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_inserts_meet_a_large_target_through_a_bloom_filter(spark, rows, tmp_path, setting):
    target, new = str(tmp_path / "target"), str(tmp_path / "new")
    spark.range(100_000).selectExpr("CAST(id AS STRING) AS k", "id % 7 AS v").write.parquet(target)
    spark.range(99_000, 101_000).selectExpr("CAST(id AS STRING) AS k", "-1L AS v").write.parquet(new)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1")
    setting("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "256MB")
    target, new = spark.read.parquet(target), spark.read.parquet(new)
    plan = absent_from(new, target, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    found = insert_ignore(target, new, ["k"])
    assert found.count() == 101_000 and found.where("v = -1").count() == 1_000


def many(spark, count):
    config = [(f"s{i}", f"p['x'].score * {i} + {i % 7}") for i in range(count)]
    return spark.createDataFrame(config, "id string, expression string")


def test_scripts_in_groups_are_one_projection_each(spark, rows, setting):
    """Twenty thousand scripts run as generated code: a projection that cannot be generated ends the run."""
    setting("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    count = 20_000
    personas = [(f"u{i % 5}", None, None, f"s{i * 97 % (count + 50)}", None, None, -1.0, "pending", 1) for i in range(300)]
    table = spark.createDataFrame(personas, table_schema("user_persona"))
    properties = spark.createDataFrame([(f"u{i}", "x", str(i), Decimal(i), i) for i in range(4)], "userKey string, property string, value string, score decimal(18,6), rank int")
    none = spark.createDataFrame([], "userKey string, type string, score decimal(18,6), text string")
    out = persona.score_persona(table, properties, none, many(spark, count), limit=count)
    expected = []
    for user, _, _, name, *_ in personas:
        script, u = int(name[1:]), int(user[1:])
        # no script of that id, or no variable: the old score stays
        expected.append((user, name, float(u * script + script % 7) if script < count and u < 4 else -1.0))
    assert rows(out, "userKey", "personaId", "scorePersona") == sorted(expected, key=repr)


def test_few_and_many_scripts_agree(spark, rows, monkeypatch):
    config = {f"s{i}": f"p['x'].value || '{i}'" for i in range(30)}
    frame = spark.range(50).selectExpr(
        "concat('s', id % 40) AS id", "map('x', named_struct('var', '', 'value', CAST(id AS STRING), 'score', 1D, 'rank', 1, 'text', '')) AS p"
    ).withColumn("id", F.when(F.col("id") != "s3", F.col("id")))
    one = scripts.with_script_texts(frame, {"text": (F.col("id"), config)})
    monkeypatch.setattr(scripts, "GROUP", 7)
    two = scripts.with_script_texts(frame, {"text": (F.col("id"), config)})
    assert one.columns == two.columns and rows(one, "id", "text") == rows(two, "id", "text")
    assert rows(scripts.with_script_texts(frame.limit(0), {"text": (F.col("id"), config)}), "id", "text") == []


@pytest.mark.parametrize("score", [persona.score_hierarchy, persona.score_phase, persona.score_persona])
def test_the_limit_of_scripts_can_be_raised(spark, score):
    none = spark.createDataFrame([], "userKey string, property string, value string, score decimal(18,6), rank int")
    evaluations = spark.createDataFrame([], "userKey string, type string, score decimal(18,6), text string")
    table = spark.createDataFrame([], table_schema("user_persona"))
    with pytest.raises(ValueError):
        score(table, none, evaluations, many(spark, 4), limit=3)
    assert score(table, none, evaluations, many(spark, 4), limit=4).collect() == []


def test_query_rows_of_two_categories_are_two_rows(spark, rows):
    entities = spark.createDataFrame([("u1",)], "userKey string")
    evals = [("e1", "0", "0", None, "economy", None, "must"), ("e2", "0", "0", None, "economy", None, "should")]
    conf = {n: Tables(spark, SF_DIR)[n] for n in ("mod_user_dimension", "int_user_dimension_measure", "int_user_evaluation_dimension")}
    conf["mod_user_evaluation"] = spark.createDataFrame(evals, table_schema("mod_user_evaluation"))
    flat = spark.createDataFrame([], "property string, value string, userKey string")
    tables = {"user_query": spark.createDataFrame([], table_schema("user_query"))}
    out = load_entities(entities, flat, tables, conf, "user")["user_query"]
    assert rows(out, "userKey", "category", "field") == [("u1", "must", "economy"), ("u1", "should", "economy")]


def test_steps_need_a_shared_folder_on_a_cluster():
    from tallyweave.session import shared_folder

    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("__", "."): v for k, v in conf.items()}

    local = {"spark__sql__warehouse__dir": "file:/work/spark-warehouse"}
    assert shared_folder(Session(**local, spark__master="local[2]"), "x").startswith("file:/work/spark-warehouse/steps/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(**local, spark__master="yarn"), "x")
    shared = Session(**local, spark__master="yarn", spark__checkpoint__dir="hdfs:/steps")
    assert shared_folder(shared, "x").startswith("hdfs:/steps/x-")
    warehouse = Session(spark__sql__warehouse__dir="hdfs:/warehouse", spark__master="yarn")
    assert shared_folder(warehouse, "x").startswith("hdfs:/warehouse/steps/x-")


def test_a_user_named_twice_has_one_query(spark):
    from tallyweave.operators import filters

    t = Tables(spark, SF_DIR)
    users = t["user_filter"].where("userKey IN ('1', '2')")
    out = filters.function_score(
        users.union(users), filters.bool_clauses(t["user_query"]), filters.persona_decay(persona.best_persona(t["user_persona"]), t["mod_persona"]), filters.cost_decay(t["user_evaluation"])
    )
    assert sorted(r["userKey"] for r in out.collect()) == ["1", "2"]
