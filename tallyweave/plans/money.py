"""Orders to settlements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.money import (
    attributed_orders,
    broker_ancestors,
    broker_lines,
    child_counts,
    mark_cleared,
    mark_settled,
    mark_settling,
    pending_orders,
    profit_rules,
    settle,
    settlement_summary,
    share_out,
    unsettled_groups,
    voucher_numbers,
    with_rules,
)
from tallyweave.operators.upsert import insert_ignore
from tallyweave.sources.tables import stage


def clear_pending_orders(
    orders: DataFrame,
    trace: DataFrame,
    brokers: DataFrame,
    schemes: DataFrame,
    items: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """Clearing rows of all pending orders.

    Broker lines are attached to the trace codes first, so each order is shuffled
    once, on its trace code, however large the broker tree is.
    """
    lines = broker_lines(broker_ancestors(brokers), child_counts(brokers))
    owners = trace.join(lines, trace["broker_id"] == lines["broker"], "left").select(
        "code",
        "platform",
        "broker_id",
        F.coalesce("parent", "broker_id").alias("__parent"),
        F.coalesce("grandpa", "broker_id").alias("__grandpa"),
        F.coalesce("parent_able", F.lit(False)).alias("__parent_able"),
        F.coalesce("grandpa_able", F.lit(False)).alias("__grandpa_able"),
    )
    # an order without a broker gets no rows, so the lookup may be an inner join here
    taken = (
        orders.where(F.col("status") == "pending")
        .drop("status")
        .withColumnRenamed("commission_settlement", "commission")
    )
    placed = taken.join(
        attributed_orders(owners).withColumnRenamed("code", "trace_code"), ["trace_code", "platform"]
    )
    return share_out(with_rules(placed, profit_rules(schemes, items), trace), as_of)


def settle_cleared(
    clearing: DataFrame, items: DataFrame, settlements: DataFrame, cutoff: Column, as_of: Column | None = None
) -> DataFrame:
    """Settlement rows of everything payable before the cutoff."""
    return settle(voucher_numbers(settlement_summary(clearing, items, cutoff), settlements), as_of)


def money_day(
    orders: DataFrame,
    trace: DataFrame,
    brokers: DataFrame,
    schemes: DataFrame,
    items: DataFrame,
    clearing: DataFrame,
    settlements: DataFrame,
    cutoff: Column,
    as_of: Column,
) -> dict[str, DataFrame]:
    """One day's run: pending orders are cleared and what is due is settled.

    Returns new snapshots of the orders, the clearing rows and the settlements, and the groups
    that cannot be settled.  Clearing rows are written once in between, as three steps read them.
    """
    new = clear_pending_orders(orders, trace, brokers, schemes, items, as_of)
    rows = stage(insert_ignore(clearing, new, ["id"]), "clearing")
    groups = stage(settlement_summary(rows, items, cutoff), "settlement-groups")
    settling = mark_settling(rows, groups, items, cutoff, as_of)
    return {
        "orders": mark_cleared(orders, trace, profit_rules(schemes, items)),
        "clearing": mark_settled(settling, groups, items, cutoff, as_of),
        "settlements": settlements.unionByName(settle(voucher_numbers(groups, settlements), as_of)),
        "unsettled": unsettled_groups(groups),
    }


__all__ = ["clear_pending_orders", "money_day", "pending_orders", "settle_cleared"]
