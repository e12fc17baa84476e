import pytest
from pyspark.sql import functions as F

from tallyweave.operators import tasks, upsert
from tallyweave.operators.pairing import pair_every
from tallyweave.schemas import table_names, table_schema
from tallyweave.sources import documents, messages
from tallyweave.sources.tables import read_table, write_table

LAYOUT = "k string, v string, status string, revision int"


def df(spark, rows, layout=LAYOUT):
    return spark.createDataFrame(rows, layout)


def test_insert_ignore_keeps_what_is_there(spark, rows):
    target = df(spark, [("a", "1", "ready", 3)])
    new = df(spark, [("a", "9", "pending", 1), ("b", "2", "pending", 1), ("b", "1", "pending", 1)])
    out = upsert.insert_ignore(target, new, ["k"])
    assert rows(out, *out.columns) == [("a", "1", "ready", 3), ("b", "1", "pending", 1)]
    again = upsert.insert_ignore(out, new, ["k"])
    assert rows(again, *out.columns) == rows(out, *out.columns)


def test_bump_counts_every_arrival(spark, rows):
    target = df(spark, [("a", "1", "ready", 3), ("c", "1", "ready", 1)])
    new = df(spark, [("a", "x", "pending", 0), ("b", "x", "pending", 0), ("b", "x", "pending", 0)])
    once = upsert.insert_or_bump_revision(target, new, ["k"])
    assert rows(once, "k", "status", "revision") == [("a", "ready", 4), ("b", "pending", 2), ("c", "ready", 1)]
    twice = upsert.insert_or_bump_revision(once, new, ["k"])
    assert rows(twice, "k", "revision") == [("a", 5), ("b", 4), ("c", 1)]


def test_bump_with_one_key_holding_a_third_of_all_rows(spark):
    new = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k", "'x' v", "'p' status")
    out = upsert.insert_or_bump_revision(df(spark, []), new, ["k"])
    assert out.where("k = 'hot'").first()["revision"] == 10_000
    assert out.count() == 20_001


def test_update_sets_nulls_too(spark, rows):
    target = df(spark, [("a", "1", "s", 1), ("b", "2", "s", 1)])
    updates = spark.createDataFrame([("a", None)], "k string, v string")
    out = upsert.update_from(target, updates, ["k"], ["v"], {"revision": F.col("revision") + 1})
    assert rows(out, "k", "v", "revision") == [("a", None, 2), ("b", "2", 1)]


def test_batches_and_marks(spark, rows):
    t = spark.createDataFrame(
        [("a", "pending", 900, 1), ("b", "pending", 950, 1), ("c", "pending", 401, 1), ("d", "ready", 990, 1)],
        "k string, status string, priority int, revision int",
    )
    assert [r["k"] for r in tasks.pending_batch(t, 5, ["k"], leaf=True).collect()] == ["b", "a"]
    assert [r["k"] for r in tasks.pending_batch(t, 5, ["k"], leaf=False).collect()] == ["c"]
    assert [r["k"] for r in tasks.pending_batch(t, 2, ["k"]).collect()] == ["b", "a"]
    marked = tasks.mark(t, tasks.pending_by_status(t, "pending", 1, ["k"]), ["k"], "ready")
    assert rows(marked.where("revision = 2"), "k", "status") == [("a", "ready")]


@pytest.mark.parametrize("state, restarted", [("ready", True), ("pending", False)])
def test_restart_only_when_idle(spark, rows, state, restarted):
    t = df(spark, [("a", "1", "ready", 1), ("b", "1", state, 1)])
    expected = [("a", "pending", 2), ("b", "pending", 2)] if restarted else [("a", "ready", 1), ("b", state, 1)]
    assert rows(tasks.restart_cycle(t), "k", "status", "revision") == expected


def test_pairing_gives_every_pair_once(spark):
    entities = spark.range(1000).selectExpr("cast(id as string) k")
    config = spark.range(7).withColumnRenamed("id", "c")
    pairs = pair_every(entities, config, "k")
    assert pairs.count() == 7000 and pairs.distinct().count() == 7000
    plan = pairs._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_table_round_trip(spark, tmp_path):
    t = spark.createDataFrame([("u1", "pending", 1)], table_schema("user_filter"))
    write_table(t, "user_filter", str(tmp_path))
    assert read_table(spark, "user_filter", str(tmp_path)).collect() == t.collect()
    with pytest.raises(ValueError):
        read_table(spark, "user_filter")
    with pytest.raises(ValueError, match="ranges"):
        read_table(spark, "user_filter", jdbc={"url": "jdbc:none"})
    for name in table_names():
        assert table_schema(name).fields


def test_documents(spark, rows, tmp_path):
    layout = "_key string, doc string, status string, index string"
    docs = spark.createDataFrame(
        [("1", '{"title":"t"}', "pending", None), ("2", '{"title":"t","tagging":"g"}', "ready", "ready")], layout
    )
    docs.write.parquet(str(tmp_path / "d"))
    assert rows(documents.read_documents(spark, str(tmp_path / "d")), "_key") == [("1",)]
    assert rows(documents.mark_taken(docs), "status") == [("ready",), ("ready",)]
    assert rows(documents.pending_index(docs), "_key", "index") == [("1", "ready")]
    sent = messages.compose_index_messages(docs)
    assert rows(sent, "value") == [
        ('{"_key":"1","tagging":"t","title":"t"}',),
        ('{"_key":"2","tagging":"g","title":"t"}',),
    ]
    assert rows(messages.read_messages(sent, "title string, tagging string"), "key", "tagging") == [("1", "t"), ("2", "g")]
    source = documents.stream_documents(spark, str(tmp_path / "d"), layout)
    query = messages.publish_index(
        messages.compose_index_messages(source), path=str(tmp_path / "m"), checkpoint=str(tmp_path / "c")
    )
    query.awaitTermination()
    assert spark.read.json(str(tmp_path / "m" / messages.INDEX_TOPIC)).count() == 2


def test_doubled_labels_double_no_property(spark, rows):
    from decimal import Decimal

    from tallyweave.operators.enrich import normalize

    layout = "property string, value string, score decimal(18,6), rank int, status string"
    props = spark.createDataFrame([("a", "x", None, None, "pending")], layout)
    labels = spark.createDataFrame([("a", "x", Decimal(1), 2, "ready"), ("a", "x", Decimal(3), 4, "ready")], layout)
    assert rows(normalize(props, labels, ["property", "value"]), "score", "rank") == [(Decimal("1.000000"), 2)]
