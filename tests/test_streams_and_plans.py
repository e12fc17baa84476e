import pytest

from suite import QUERIES
from tallyweave.operators import money
from tallyweave.operators.flatten import flatten_documents
from tallyweave.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"
STREAMS = [n for n in QUERIES if n.startswith("stream_")]


def test_upsert_stream_goes_on_from_its_checkpoint(spark, rows, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "check"))
    layout = "userKey string, doc string"
    for batch in (['{"a":1}', '{"a":1}'], ['{"a":1,"b":2}']):
        spark.createDataFrame([("u", d) for d in batch], layout).write.mode("append").parquet(source)
        docs = spark.readStream.schema(layout).parquet(source)
        keys = ["property", "value", "userKey"]
        jobs.stream_property_upsert(flatten_documents(docs, ["userKey"]), keys, out, checkpoint).awaitTermination()
    current = jobs.current_properties(spark, keys, out)
    assert rows(current, "property", "value", "revision") == [("a", "1", 3), ("b", "2", 1)]


def test_late_rows_are_settled_by_the_next_voucher(spark, rows, tmp_path):
    """Files out of date order over several runs: every payable row is paid, whatever its day."""
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "check"))
    layout = (
        "beneficiary string, scheme_item_id string, amount_profit decimal(18,2), create_date timestamp, "
        "status_clear string, status_settle string"
    )
    items = spark.createDataFrame([("i1", "broker"), ("i2", "platform")], "id string, beneficiary string")
    runs = [[(1, "i1"), (20, "i1"), (2, "i2")], [(1, "i1"), (3, "i2"), (25, "gone")], [(1, "i1"), (1, "i2")]]
    for days in runs:
        cleared = [("b", i, d, f"2024-01-{d:02d} 10:00:00", "cleared", "pending") for d, i in days]
        new = spark.createDataFrame(cleared + [("b", "i1", 9, "2024-01-01 10:00:00", "locked", "pending")])
        typed = new.selectExpr("_1", "_2", "CAST(_3 AS decimal(18,2))", "CAST(_4 AS timestamp)", "_5", "_6")
        typed.toDF(*[c.split(" ")[0] for c in layout.split(", ")]).write.mode("append").parquet(source)
        feed = spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(source)
        jobs.stream_settle(feed, items, out, checkpoint).awaitTermination()
    found = jobs.earlier_settlements(spark, out)
    everything = spark.read.schema(layout).parquet(source)
    summary = money.settlement_summary(everything, items, None)
    expected = summary.where("type IS NOT NULL").groupBy("type").sum("amount")
    assert rows(found.groupBy("type").sum("amount"), "type", "sum(amount)") == rows(expected, "type", "sum(amount)")
    assert found.select("id").distinct().count() == found.count()
    first = found.where("voucher LIKE '2024-01-01-broker%'").count()
    assert rows(found.where("voucher LIKE '2024-01-01-broker%'"), "voucher") == sorted(
        ("2024-01-01-broker" + (f"-{n}" if n > 1 else ""),) for n in range(1, first + 1)
    )
    assert rows(spark.read.parquet(f"{out}/unsettled"), "scheme_item_id") == [("gone",)]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_plans_stay_in_the_jvm_and_cross_nothing(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
