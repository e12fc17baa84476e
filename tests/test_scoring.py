from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.functions.scripts import check_scripts, read_scripts, text_to_score, variables_of
from tallyweave.functions.text import field_name, hex_uuid, path_depth, sub_type
from tallyweave.operators import evaluation as ev
from tallyweave.operators import filters, load, persona, scoring
from tallyweave.operators.profile import entity_profile, profile_rows

MEASURE = "userKey string, dimension string, score decimal(18,6), status string"
TREE = "id string, parent_id string, weight decimal(6,3)"


def measures(spark, scores):
    rows = [("u", d, None if s is None else Decimal(s), "pending") for d, s in scores.items()]
    return spark.createDataFrame(rows, MEASURE)


def by_levels(tree, leaves, scores):
    """Plain recursion from the bottom up."""
    kids = {}
    for i, p, w in tree:
        kids.setdefault(p, []).append((i, w))

    def score(node):
        if node in leaves:
            return scores.get(node)
        parts = [Decimal(w) * s for i, w in kids.get(node, []) if (s := score(i)) is not None]
        return sum(parts) if parts else None

    return {i: score(i) for i, _, _ in tree}


TREES = [
    ([("r", "0", "1"), ("a", "r", "0.5"), ("b", "r", "0.3"), ("a1", "a", "0.6"), ("b1", "b", "0.25")], {"a1", "b1"}),
    ([("r", "0", "1"), ("a", "r", "0.5"), ("a1", "a", "0.6")], {"a", "a1"}),
    ([("r", "0", "1"), ("a", "r", "0.5"), ("b", "r", "0.5"), ("a1", "a", "0.6")], {"a1"}),
    ([("r", "0", "1")], set()),
    ([(f"n{i}", f"n{i - 1}", "0.9") for i in range(1, 5)] + [("n0", "-", "1")], {"n4"}),
]


@pytest.mark.parametrize("tree, leaves", TREES)
def test_roll_up_equals_level_by_level(spark, tree, leaves):
    scores = {leaf: Decimal("0.5") for leaf in leaves}
    rows = measures(spark, {i: scores.get(i) for i, _, _ in tree})
    config = spark.createDataFrame([(i, p, Decimal(w)) for i, p, w in tree], TREE)
    ids = spark.createDataFrame([(x,) for x in leaves], "id string")
    out = scoring.roll_up(rows, "dimension", "userKey", config, ids)
    got = {r["dimension"]: r["score"] for r in out.collect()}
    expected = by_levels(tree, leaves, scores)
    assert {k: None if v is None else round(v, 6) for k, v in expected.items()} == got
    assert {r["status"] for r in out.where(~F.col("dimension").isin(list(leaves))).collect()} <= {"ready"}


def test_roll_up_refuses_a_circle(spark):
    tree = spark.createDataFrame([("a", "b", Decimal(1)), ("b", "a", Decimal(1)), ("x", "a", Decimal(1))], TREE)
    ids = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(ValueError):
        scoring.tree_paths(tree, ids)
    long = spark.range(3000).selectExpr("string(id) id", "string((id + 1) % 3000) parent_id", "1BD weight")
    with pytest.raises(ValueError):
        scoring.tree_paths(long, ids)


def test_roll_up_refuses_repeated_ids(spark):
    tree = spark.createDataFrame([("a", "-", Decimal(1)), ("a", "b", Decimal(1))], TREE)
    with pytest.raises(ValueError):
        scoring.tree_paths(tree, spark.createDataFrame([("x",)], "id string"))


def test_a_chain_of_thirty_thousand_nodes(spark):
    n = 30_000
    chain = spark.range(n).selectExpr("string(id) id", "string(id + 1) parent_id", "CAST(1 AS decimal(6,3)) weight")
    paths, inner = scoring.tree_paths(chain, spark.createDataFrame([("0",)], "id string"))
    assert paths.count() == n - 1 == inner.count()
    assert paths.select("ancestor").distinct().count() == n - 1


def test_measures_use_only_the_entity_itself(spark, rows):
    measure = spark.createDataFrame([(u, "d", None, "pending") for u in ("u", "w", "z")], MEASURE)
    mapping = spark.createDataFrame([("d", "p1", Decimal("0.5")), ("d", "p2", Decimal("0.25"))], "dimension string, property string, weight decimal(6,3)")
    props = spark.createDataFrame(
        [("u", "p1", Decimal(1)), ("u", "p2", Decimal(2)), ("w", "p1", Decimal(4)), ("w", "p2", None)],
        "userKey string, propertyId string, score decimal(18,6)",
    )
    out = scoring.measure_by_property(measure, mapping, props, "userKey")
    assert rows(out, "userKey", "score", "status") == [
        ("u", Decimal("1.000000"), "ready"),
        ("w", Decimal("2.000000"), "ready"),
        ("z", None, "ready"),
    ]


EVALUATION = (
    "userKey string, evaluation string, type string, category string, persona string, featured boolean, "
    "score decimal(18,6), text string, status string"
)


def evaluations(spark, rows):
    return spark.createDataFrame(rows, EVALUATION)


def test_weighted_keeps_rows_without_scores(spark, rows):
    e = evaluations(spark, [("u", "e", "economy", "must", None, True, None, None, "pending"), ("w", "e", "economy", "must", None, True, None, None, "pending")])
    mapping = spark.createDataFrame([("e", "Economy", "d", Decimal("0.5"))], "evaluation string, type string, dimension string, weight decimal(6,3)").withColumn("type", F.lit("economy"))
    m = measures(spark, {"d": "0.8"})
    out = scoring.evaluate_weighted(e, mapping, m, "userKey", scoring.WEIGHTED_TYPES["user"])
    assert rows(out, "userKey", "score", "status") == [("u", Decimal("0.400000"), "ready"), ("w", None, "pending")]


def test_routes(spark):
    types = ["A", "z", "satisify", "Satisfy", "context", "do-not-care", "style", "tags"]
    df = spark.createDataFrame([(t,) for t in types], "type string")
    assert [r["route"] for r in ev.route_by_type(df, "item").collect()] == [
        "weighted", "weighted", "motivation", "motivation", "occasion", "ignore", "script", "script",
    ]
    users = spark.createDataFrame([(t,) for t in ["perform", "Demands", "persona", "phase", "style", "brand::tags"]], "type string")
    assert [r["route"] for r in ev.route_by_type(users, "user").collect()] == [
        "weighted", "motivation", "persona", "ignore", "ignore", "script",
    ]


def test_tags_follow_the_list_and_leave_unmatched_rows(spark, rows):
    owners = spark.createDataFrame([("o", "m2, m1,m9"), ("p", "")], "id string, ids string")
    tags = spark.createDataFrame([("m1", "one"), ("m2", "two")], "id string, name string")
    texts = ev.tag_texts(owners, "id", "ids", tags)
    e = evaluations(spark, [("u", "e", "demands", "must", o, True, None, "old", "pending") for o in ("o", "p")])
    out = ev.evaluate_tags(e, ["demands"], "persona", texts)
    assert rows(out, "persona", "text", "status") == [("o", "two one ", "ready"), ("p", "old", "pending")]


def test_names_of_types(spark):
    df = spark.createDataFrame([("brand::tags",), ("style",), ("brand::",)], "t string")
    got = [tuple(r) for r in df.select(sub_type(F.col("t")), field_name(F.col("t"))).collect()]
    assert got == [("brand", "tags"), ("-", "style"), ("-", "brand")]


def test_path_depth(spark):
    df = spark.createDataFrame([("0,",), ("0,a,b",), ("0,a,,",), ("",), (",",), (None,)], "p string")
    assert [r[0] for r in df.select(path_depth(F.col("p"))).collect()] == [1, 3, 2, 1, 0, 0]
    assert len(spark.range(1).select(hex_uuid()).first()[0]) == 32


def test_scripts_must_be_scalar(spark):
    frame = spark.range(1)
    check_scripts(frame, ["p['a'].score * 2", "concat(p['from'].value, 'select')"])
    for bad in ("sum(p['a'].score)", "(select 1)", "explode(array(1))", "row_number() over (order by 1)"):
        with pytest.raises(Exception):
            check_scripts(frame, [bad])
    check_scripts(frame, ["extract(YEAR FROM date'2020-01-01')"])
    for bad in ("java_method('java.lang.Integer', 'parseInt', '42')", "rand()", "uuid()", "p[concat('a', 'b')].score",
                "size(map_keys(p))", "to_json(p)"):
        with pytest.raises(Exception):
            check_scripts(frame, [bad])
    spelled = ["p['a'].score + p[ 'b.c' ].rank", 'p["a"].text', "p.d.rank", "element_at(p, 'e').rank + p.`f.g`.rank"]
    assert variables_of(spelled) == ["a", "b.c", "d", "e", "f.g"]
    config = spark.createDataFrame([("1", "'x'"), ("2", "'y'")], "id string, script string")
    with pytest.raises(ValueError):
        read_scripts(config, "id", "script", limit=1)


def test_script_results_as_scores(spark):
    df = spark.createDataFrame([("true",), ("false",), ("1.5",), ("word",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_score(F.col("t"))).collect()] == [1.0, 0.0, 1.5, None, None]


def profile_inputs(spark):
    props = spark.createDataFrame(
        [("u", "a", "x", Decimal("0.5"), 3), ("u", "t", "v", Decimal("0.1"), 7), ("w", "a", "y", None, None)],
        "userKey string, property string, value string, score decimal(18,6), rank int",
    )
    evals = evaluations(spark, [("u", "e", "t", "must", None, True, Decimal("0.9"), "txt", "ready")])
    return props, evals


def test_profile_evaluations_take_over(spark, rows):
    props, evals = profile_inputs(spark)
    out = rows(profile_rows(props, evals, "userKey"), "userKey", "name", "var", "value", "score", "rank", "text")
    assert ("u", "t", "0.9", "v", Decimal("0.900000"), 7, "txt") in out
    assert ("u", "a", "x", "x", Decimal("0.500000"), 3, None) in out
    wide = {r["userKey"]: r["p"] for r in entity_profile(props, evals, "userKey", ["t", "a"]).collect()}
    assert wide["u"]["t"]["rank"] == 7 and wide["u"]["t"]["var"] == "0.9" and "t" not in wide["w"]


def test_profile_of_an_entity_with_most_rows(spark):
    props = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) userKey", "concat('p', id % 50) property", "cast(id as string) value",
        "cast(0.5 as decimal(18,6)) score", "cast(id % 9 as int) rank",
    )
    out = entity_profile(props, None, "userKey", ["p0", "p3"])
    hot = out.where("userKey = 'hot'").first()["p"]
    best = max(str(i) for i in range(0, 20_000, 3) if i % 50 == 0)
    assert hot["p0"]["value"] == best


def test_scores_keep_the_old_value_without_a_number(spark, rows):
    props, evals = profile_inputs(spark)
    pairs = spark.createDataFrame(
        [("u", "h1", 9.0), ("u", "h2", 9.0), ("u", "h3", 9.0), ("w", "h1", 9.0), ("u", "gone", 9.0)],
        "userKey string, hierarchyId string, scoreHierarchy double",
    )
    config = spark.createDataFrame(
        [("h1", "p['a'].score * 2"), ("h2", "p['t'].text = 'txt'"), ("h3", "p['a'].value")], "id string, expression string"
    )
    out = persona.score_hierarchy(pairs, props, evals, config)
    assert rows(out, "userKey", "hierarchyId", "scoreHierarchy") == [
        ("u", "gone", 9.0), ("u", "h1", 1.0), ("u", "h2", 1.0), ("u", "h3", 9.0), ("w", "h1", 9.0),
    ]


def test_best_persona_order(spark, rows):
    layout = "userKey string, personaId string, scoreHierarchy double, scorePhase double, scorePersona double"
    pairs = spark.createDataFrame(
        [("u", "b", 1.0, None, 5.0), ("u", "c", 1.0, 0.0, 1.0), ("u", "d", 1.0, 0.0, 1.0), ("w", "x", None, None, None)], layout
    )
    best = persona.best_persona(pairs)
    assert rows(best, "userKey", "personaId") == [("u", "c"), ("w", "x")]
    assert "WindowGroupLimit" in best._jdf.queryExecution().toString()


def test_filter_document(spark):
    users = spark.createDataFrame([("u",), ("none",)], "userKey string")
    query = spark.createDataFrame(
        [("u", c, "match", f, t) for c, f, t in [("Must", "title", "a"), ("must_not", "b", "c"), ("should", "d", "e"), ("filter", "f", "g"), ("other", "x", "y"), ("must", "z", ""), ("must", "q", None)]],
        "userKey string, category string, type string, field string, text string",
    )
    best = spark.createDataFrame([("u", "p")], "userKey string, personaId string")
    personas = spark.createDataFrame([("p", "0.1", "x", None, "1", "")], "id string, alpha string, beta string, gamma string, delte string, epsilon string")
    evals = evaluations(spark, [("u", "e1", "economy", None, None, True, Decimal("0.3"), None, "ready"), ("u", "e2", "economy", None, None, True, Decimal("0.7"), None, "ready"), ("u", "e3", "culture", None, None, True, None, None, "ready")])
    import json

    out = filters.function_score(users, filters.bool_clauses(query), filters.persona_decay(best, personas), filters.cost_decay(evals))
    docs = {r["userKey"]: json.loads(r["query"])["function_score"] for r in out.collect()}
    assert docs["u"]["query"]["bool"] == {
        "must": [{"match": {"title": "a"}}],
        "must_not": [{"match": {"b": "c"}}],
        "should": [{"match": {"d": "e"}}],
        "filter": [{"match": {"f": "g"}}],
    }
    origins = {k: v["origin"] for f in docs["u"]["functions"] if "gauss" in f for k, v in f["gauss"].items()}
    assert origins == {"a": 0.1, "b": 0.5, "c": 0.5, "d": 1.0, "e": 0.5, "x": 0.3, "z": 0.5}
    assert docs["none"]["query"]["bool"] == {} and len(docs["none"]["functions"]) == 1
    assert (docs["u"]["boost"], docs["u"]["score_mode"], docs["u"]["boost_mode"]) == ("2", "multiply", "multiply")


def test_feature_copies_go_to_the_nested_object(spark, rows):
    docs = spark.createDataFrame([("u", '{"evaluate":{"old":1,"t":2},"a":1}', "ready"), ("w", '{"a":1}', "ready")], "_key string, doc string, status string")
    evals = evaluations(spark, [("u", "e", "t", "must", None, True, None, "new", "ready"), ("w", "e", "t", "must", None, False, None, "new", "ready")])
    out = ev.sync_features(docs, evals, "userKey", nest="evaluate")
    assert rows(out, "_key", "doc", "status") == [("u", '{"a":1,"evaluate":{"old":1,"t":"new"}}', "pending"), ("w", '{"a":1}', "ready")]


def test_priorities(spark, rows):
    evals = spark.createDataFrame(
        [("e1", "0", "0,", Decimal(1), "perform", None, None), ("e2", "e1", "0,e1,", Decimal(1), "economy", None, None)],
        "id string, parent_id string, parent_ids string, weight decimal(6,3), type string, script string, category string",
    )
    mapping = spark.createDataFrame([("e1", "d", Decimal(1)), ("e2", "d", Decimal(1))], "evaluation_id string, dimension_id string, weight decimal(6,3)")
    users = spark.createDataFrame([("u",)], "userKey string")
    tasks = load.evaluate_tasks(users, evals, "userKey")
    assert rows(tasks, "evaluation", "priority") == [("e1", 801), ("e2", 2)]
    assert rows(load.promote_evaluated(tasks, evals, mapping), "evaluation", "priority") == [("e1", 1700), ("e2", 0)]


@pytest.mark.parametrize("script", ["p['seg'].rank", 'p["seg"].rank', "p.seg.rank", "element_at(p, 'seg').rank", "p.`seg`.rank"])
def test_every_spelling_of_a_variable_is_read(spark, script):
    props = spark.createDataFrame(
        [("u", "seg", "x", Decimal("0.5"), 7)],
        "userKey string, property string, value string, score decimal(18,6), rank int",
    )
    profile = entity_profile(props, None, "userKey", variables_of([script, "p['none'].rank"]))
    assert profile.select(F.expr(script)).first()[0] == 7
    assert profile.select(F.expr("p['none'].rank")).first()[0] is None
