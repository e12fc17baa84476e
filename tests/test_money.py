import datetime
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import money
from tallyweave.plans.money import clear_pending_orders
from tallyweave.schemas import table_schema

DAY = datetime.datetime(2024, 1, 1, 10)


def table(spark, name, rows):
    return spark.createDataFrame(rows, table_schema(name))


def market(spark, items, commission="100.00", children=15):
    orders = table(
        spark, "mod_order", [("o1", "it", Decimal("10.00"), DAY, "p1", "t1", Decimal(commission), "pending")]
    )
    trace = table(spark, "mod_trace_code", [("t1", "p1", "b1")])
    brokers = table(
        spark,
        "mod_broker",
        [("b1", "b2"), ("b2", "b3"), ("b3", " ")] + [(f"x{i}", "b2") for i in range(children - 1)],
    )
    schemes = table(spark, "mod_profit_share_scheme", [("s1", "default", "p1"), ("s2", "other", "p1"), ("s3", "default", "p1")])
    rules = table(spark, "mod_profit_share_item", [(f"i{n}", "s1", *item) for n, item in enumerate(items)] + [("z", "s2", "broker", "person", "1")])
    return orders, trace, brokers, schemes, rules


@pytest.mark.parametrize(
    "item, children, person, state",
    [
        (("broker", "person", "10"), 15, "b1", "cleared"),
        (("parent", "person", "10"), 15, "b2", "cleared"),
        (("parent", "person", "10"), 14, "b2", "locked"),
        (("grandpa", "person", "10"), 15, "b3", "locked"),
        (("team-x", "Team", "10"), 15, "team-x", "pending"),
        (("Platform", "person", "10"), 15, "platform", "cleared"),
        (("mentor", "person", "10"), 15, "null-mentor", "cleared"),
        (("Parent", "person", "10"), 15, "null-Parent", "locked"),
    ],
)
def test_branches(spark, rows, item, children, person, state):
    cleared = clear_pending_orders(*market(spark, [item], children=children), F.lit(DAY))
    assert rows(cleared, "beneficiary", "status_clear", "status_settle") == [(person, state, "pending")]
    expected = hashlib.md5(f"o1s1i0{item[1]}{item[0]}{person}".encode()).hexdigest()
    assert rows(cleared, "id") == [(expected,)]


@pytest.mark.parametrize(
    "share, commission, profit",
    [
        ("1", "101.50", "1.02"),
        ("1", "102.50", "1.02"),
        ("1", "100.50", "1.00"),
        ("none", "100.00", "0.00"),
        (None, "100.00", "0.00"),
        ("0.5", "100.00", "0.50"),
    ],
)
def test_profit_halves_go_to_the_even_cent(spark, rows, share, commission, profit):
    cleared = clear_pending_orders(*market(spark, [("broker", "person", share)], commission))
    assert rows(cleared, "amount_profit") == [(Decimal(profit),)]


def test_both_ways_to_clear_agree_and_reruns_give_the_same_ids(spark, rows):
    orders, trace, brokers, schemes, rules = market(spark, [("broker", "person", "60"), ("parent", "person", "7")])
    one = clear_pending_orders(orders, trace, brokers, schemes, rules, F.lit(DAY))
    two = money.clear_orders(
        money.pending_orders(orders, trace),
        money.profit_rules(schemes, rules),
        money.broker_ancestors(brokers),
        money.child_counts(brokers),
        F.lit(DAY),
    )
    assert rows(one, *one.columns) == rows(two, *one.columns)


def test_orders_without_broker_stay_in_clearing(spark, rows):
    orders, trace, brokers, schemes, rules = market(spark, [("broker", "person", "60")])
    orders = orders.union(orders.withColumn("id", F.lit("o2")).withColumn("trace_code", F.lit("none")))
    taken = money.pending_orders(orders, trace)
    assert rows(money.unattributed_orders(taken), "id") == [("o2",)]
    marked = money.mark_cleared(orders, trace, money.profit_rules(schemes, rules))
    assert rows(marked, "id", "status") == [("o1", "cleared"), ("o2", "clearing")]


def clearing_rows(spark, rows):
    base = ("p1", "o", DAY, "it", Decimal(1), Decimal(1))
    full = [
        (str(n), *base, Decimal(amount), "s", item, who, "person", "1", state, settle, at, at)
        for n, (who, item, amount, state, settle, at) in enumerate(rows)
    ]
    return table(spark, "mod_clearing", full)


def test_settlement_cycle(spark, rows):
    items = table(spark, "mod_profit_share_item", [("i1", "s", "broker", "person", "1"), ("i2", "s", "broker", "person", "2")])
    later = DAY + datetime.timedelta(days=5)
    clearing = clearing_rows(
        spark,
        [
            ("b1", "i1", "1.10", "cleared", "pending", DAY),
            ("b1", "i2", "2.20", "cleared", "pending", DAY),
            ("b1", "i1", "9.00", "locked", "pending", DAY),
            ("b1", "i1", "9.00", "cleared", "settled", DAY),
            ("b1", "i1", "9.00", "cleared", "pending", later),
            ("b1", "gone", "3.00", "cleared", "pending", DAY),
        ],
    )
    cutoff = F.lit(DAY + datetime.timedelta(days=1))
    summary = money.settlement_summary(clearing, items, cutoff)
    assert rows(summary, "type", "scheme_item_id", "scheme_items", "amount") == [
        ("broker", "i1", 2, Decimal("3.30")),
        (None, "gone", 1, Decimal("3.00")),
    ]
    settlements = table(spark, "mod_settlement", [])
    for expected in ("2024-01-01-broker", "2024-01-01-broker-2", "2024-01-01-broker-3"):
        new = money.settle(money.voucher_numbers(summary, settlements), F.lit(DAY))
        assert rows(new, "voucher", "id") == [(expected, hashlib.md5(f"b1-{expected}".encode()).hexdigest())]
        settlements = settlements.unionByName(new)
    settling = money.mark_settling(clearing, summary, items, cutoff)
    assert rows(settling, "id", "status_settle") == [
        ("0", "settling"), ("1", "settling"), ("2", "pending"), ("3", "settled"), ("4", "pending"), ("5", "pending"),
    ]
    settled = money.mark_settled(settling, summary, items, cutoff)
    assert rows(settled.where("status_settle = 'settled'"), "id") == [("0",), ("1",), ("3",)]
    assert settled.columns == clearing.columns


def test_sums_settled_equal_sums_cleared_with_one_hot_beneficiary(spark):
    n = 30_000
    clearing = spark.range(n).selectExpr(
        "cast(id as string) id",
        "if(id % 3 = 0, 'platform', concat('b', id % 500)) beneficiary",
        "if(id % 2 = 0, 'i1', 'i2') scheme_item_id",
        "cast(id % 100 / 100 as decimal(18,2)) amount_profit",
        "'cleared' status_clear",
        "'pending' status_settle",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 7 as int)) create_date",
    )
    items = table(spark, "mod_profit_share_item", [("i1", "s", "broker", "p", "1"), ("i2", "s", "platform", "p", "2")])
    summary = money.settlement_summary(clearing, items, F.lit(DAY + datetime.timedelta(days=30)))
    total = clearing.agg(F.sum("amount_profit")).first()[0]
    assert summary.agg(F.sum("amount")).first()[0] == total
