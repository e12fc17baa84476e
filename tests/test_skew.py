"""Clearing when one trace code holds a third of all orders and nothing can be broadcast."""

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import money
from tallyweave.plans.money import clear_pending_orders

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "100k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "16",
}
ORDERS, CODES = 600_000, 200_000


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_the_hot_code_is_split_and_no_row_is_lost(spark, small_limits):
    orders = spark.range(0, ORDERS, 1, 16).selectExpr(
        "cast(id as string) id",
        "'it' item",
        "cast(1 as decimal(18,2)) amount",
        "timestamp'2024-01-01' order_time",
        "'p1' platform",
        f"if(mod(id, 3) = 0, '7', cast(mod(id, {CODES}) as string)) trace_code",
        "cast(100 as decimal(18,2)) commission_settlement",
        "'pending' status",
    )
    trace = spark.range(CODES).selectExpr("cast(id as string) code", "'p1' platform", "cast(id as string) broker_id")
    brokers = spark.range(CODES).selectExpr("cast(id as string) id", "cast(floor(id / 20) as string) parent_id")
    schemes = spark.sql("SELECT 's' id, 'default' category, 'p1' platform")
    items = spark.sql(
        "SELECT 'i1' id, 's' scheme_id, 'broker' beneficiary, 'person' beneficiary_type, '60' share "
        "UNION ALL SELECT 'i2', 's', 'parent', 'person', '10'"
    )
    cleared = clear_pending_orders(orders, trace, brokers, schemes, items)
    # order ids are read too: rows that were all alike would compress to nothing
    totals = cleared.groupBy("scheme_item_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_profit").alias("a"), F.max("order_id").alias("last")
    )
    got = {r["scheme_item_id"]: (r["n"], int(r["a"])) for r in totals.collect()}
    assert got == {"i1": (ORDERS, ORDERS * 60), "i2": (ORDERS, ORDERS * 10)}
    final = totals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in final


def test_orders_of_one_platform_meet_its_rules_in_many_tasks(spark, small_limits):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    orders = spark.range(2000).selectExpr("cast(id as string) id", "'p1' platform", "'b' broker_id")
    rules = spark.range(3).selectExpr("'p1' platform", "cast(id as string) scheme_item_id")
    met = money.with_rules(orders, rules, spark.sql("SELECT 'p1' platform"))
    assert met.columns == ["platform", "id", "broker_id", "scheme_item_id"]
    tasks = met.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in tasks) == 6000
    assert max(r["n"] for r in tasks) < 3000
