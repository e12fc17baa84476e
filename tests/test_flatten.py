import json
import random

import pytest

from tallyweave.operators.flatten import FAST_LEVELS, flatten_documents, flatten_merge, refused_documents


def flat(spark, doc, op=flatten_documents):
    df = op(spark.createDataFrame([("k", doc)], "k string, doc string"), ["k"])
    return {r["property"]: r["value"] for r in df.collect()}


@pytest.mark.parametrize(
    "doc, expected",
    [
        ('{"a":{"b":{"c":"x"}}}', {"a.b.c": "x"}),
        ('{"a":[{"b":1},{"b":2}]}', {"a.0.b": "1", "a.1.b": "2"}),
        ('{"a":[1,2.5,"q",null,true]}', {"a": "[1, 2.5, q, null, true]"}),
        ('{"a":[]}', {"a": "[]"}),
        ('{"a":null}', {"a": "null"}),
        ('{"a":{}}', {}),
        ('{"a":"{\\"b\\":1}"}', {"a": '{"b":1}'}),
        ('{"a":1.0,"b":12345678.5}', {"a": "1.0", "b": "12345678.5"}),
        ('{"a":9007199254740993.5,"b":-20.0,"c":0.0000001}', {"a": "9007199254740993.5", "b": "-20.0", "c": "0.0000001"}),
        ('{"a":123456789012345678901234567890,"b":7,"c":[900.0, 2.50]}', {"a": "123456789012345678901234567890", "b": "7", "c": "[900.0, 2.5]"}),
        ('{"a":[[1,2],[3]]}', {"a": "[[1, 2], [3]]"}),
        ('{"a":[{"b":1},5]}', {"a.0.b": "1", "a.1": "5"}),
        ('{"a":[null,{"b":1}]}', {"a": "[null, {b=1}]"}),
    ],
)
def test_shapes(spark, doc, expected):
    assert flat(spark, doc) == expected


def brute(value, path=""):
    """Plain recursion over the parsed document."""
    for key, v in value.items():
        name = f"{path}.{key}" if path else key
        if isinstance(v, dict):
            yield from brute(v, name)
        elif isinstance(v, list) and v and isinstance(v[0], dict):
            for i, x in enumerate(v):
                yield from brute(x, f"{name}.{i}")
        else:
            yield name, f"[{', '.join(map(str, v))}]" if isinstance(v, list) else str(v)


def nested(rng, depth):
    if depth == 0:
        return rng.choice([1, "t", [1, 2], "x y"])
    kind = rng.random()
    if kind < 0.5:
        return {f"k{i}": nested(rng, depth - 1) for i in range(2)}
    if kind < 0.8:
        return [{"e": nested(rng, depth - 1)} for _ in range(2)]
    return rng.randint(0, 9)


def test_any_depth_equals_plain_recursion(spark):
    rng = random.Random(7)
    docs = [(str(i), json.dumps({"r": nested(rng, FAST_LEVELS + 4), "s": i})) for i in range(40)]
    got = flatten_documents(spark.createDataFrame(docs, "k string, doc string"), ["k"])
    expected = sorted((k, p, v) for k, d in docs for p, v in brute(json.loads(d)))
    assert sorted((r["k"], r["property"], r["value"]) for r in got.collect()) == expected


def test_merge(spark):
    doc = json.dumps(
        {
            "l": [{"x": 1}, {"x": 2, "y": 3}],
            "n": None,
            "s": json.dumps({"k": 1, "t": json.dumps({"u": None})}),
            "plain": "2018-06-05 10:02:24",
            "brace": "\n {not json",
            "deep": {"a": {"b": {"c": {"d": {"e": [{"f": {"g": 1}}, {"f": {"g": 2}}]}}}}},
        }
    )
    assert flat(spark, doc, flatten_merge) == {
        "l.x": "2",
        "l.y": "3",
        "n": None,
        "s.k": "1",
        "s.t.u": None,
        "plain": "2018-06-05 10:02:24",
        "brace": "\n {not json",
        "deep.a.b.c.d.e.f.g": "2",
    }


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 9])
def test_list_text_is_the_same_at_any_depth(spark, depth):
    inner = '[1, 2.5, "x", null, {"k": [true]}]'
    doc = '{"a":' + "[" * depth + inner[1:-1] + "]" * depth + "}"
    df = spark.createDataFrame([("u", doc)], "k string, doc string")
    expected = "[" * depth + "1, 2.5, x, null, {k=[true]}" + "]" * depth
    for flatten in (flatten_documents, flatten_merge):
        assert [tuple(r) for r in flatten(df, ["k"]).select("property", "value").collect()] == [("a", expected)]


@pytest.mark.parametrize("levels", [3, 6, 12])
@pytest.mark.parametrize("escaped", [False, True])
def test_embedded_documents_open_at_any_depth(spark, levels, escaped):


    inner = {"leaf": 1}
    for i in range(levels - 1, 0, -1):
        inner = {f"n{i}": [inner, inner]}
    text = json.dumps(inner)
    held = json.dumps(text)
    if escaped:
        held = held.replace("{", "\\u007b").replace("}", "\\u007d")
    df = spark.createDataFrame([("u", '{"s":' + held + "}")], "k string, doc string")
    path = ".".join(["s", *[f"n{i}" for i in range(1, levels)], "leaf"])
    assert [tuple(r) for r in flatten_merge(df, ["k"]).select("property", "value").collect()] == [(path, "1")]


def test_refused_documents_are_listed_and_stop_nothing(spark):
    rows = [("ok", '{"a":1}'), ("cut", '{"a":'), ("twice", '{"a":1,"a":2}'), ("none", None)]
    df = spark.createDataFrame(rows, "k string, doc string")
    assert sorted(r["k"] for r in refused_documents(df).collect()) == ["cut", "twice"]
    for flatten in (flatten_documents, flatten_merge):
        found = {(r["k"], r["property"], r["value"]) for r in flatten(df, ["k"]).collect()}
        assert ("ok", "a", "1") in found
        assert not {k for k, _, _ in found} & {"cut", "twice"}


def test_long_lists_are_opened_in_linear_time(spark):
    """Twice the points, about twice the time: the number of brackets is not the number of rounds over all nodes."""
    import time

    def seconds(points, op):
        deep = {"r": {"s": {"t": {"u": {"v": [{"x": [i, i]} for i in range(points)]}}}}}
        wide = {"a": [[i, i] for i in range(points)]}
        df = spark.createDataFrame([("k", json.dumps(deep)), ("w", json.dumps(wide))], "k string, doc string")
        start = time.perf_counter()
        rows = op(df, ["k"]).collect()
        taken = time.perf_counter() - start
        if op is flatten_documents:
            assert len(rows) == points + 1
        return taken

    for op in (flatten_documents, flatten_merge):
        seconds(100, op)
        small, large = seconds(2000, op), seconds(8000, op)
        assert large < 8 * small + 2


def test_refusals_are_counted_as_documents_pass(spark):
    from pyspark.sql import Observation
    from tallyweave.sources.messages import compose_index_messages

    rows = [("ok", '{"a":1}'), ("cut", '{"a":'), ("twice", '{"a":1,"a":2}'), ("none", None), ("more", '{"b":[{"c":2}]}')]
    df = spark.createDataFrame(rows, "_key string, doc string")
    for op in (lambda o: flatten_documents(df, ["_key"], counted=o), lambda o: flatten_merge(df, ["_key"], counted=o), lambda o: compose_index_messages(df, o)):
        counts = Observation()
        made = op(counts)
        assert made._jdf.queryExecution().optimizedPlan().toString().count("parseJson(doc") == 1
        made.collect()
        assert counts.get == {"read": 5, "refused": 2}
    both = flatten_documents(df, ["_key"]).union(flatten_documents(df, ["_key"]))
    assert both.where("_key = 'ok'").count() == 2


def test_refusals_of_a_stream(spark, tmp_path):
    from tallyweave.streaming import jobs

    source = str(tmp_path / "in")
    spark.createDataFrame([("a", '{"x":1}'), ("b", "{"), ("c", '{"y":2}')], "k string, doc string").write.parquet(source)
    docs = spark.readStream.schema("k string, doc string").parquet(source)
    query = jobs.stream_flatten(docs, ["k"], str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    assert jobs.refusals(query) == (3, 1)
