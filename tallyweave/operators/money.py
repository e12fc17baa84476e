"""Order commission to profit-share rows, and their daily settlement."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import blank, digest
from tallyweave.operators.pairing import LEAST_SALTS
from tallyweave.operators.upsert import one_row_per_key
from tallyweave.schemas import MONEY, SHARE

# Fixed values.
QUALIFYING_CHILDREN = 15
DEFAULT_CATEGORY = "default"


def pending_orders(orders: DataFrame, trace: DataFrame) -> DataFrame:
    """Pending orders with the broker behind their trace code, null when there is none."""
    open_orders = orders.where(F.col("status") == "pending").drop("status")
    owners = trace.select(F.col("code").alias("trace_code"), "platform", "broker_id")
    return open_orders.withColumnRenamed("commission_settlement", "commission").join(
        owners, ["trace_code", "platform"], "left"
    )


def mark_clearing(orders: DataFrame) -> DataFrame:
    """The order table after its pending orders were taken."""
    taken = F.col("status") == "pending"
    return orders.withColumn("status", F.when(taken, F.lit("clearing")).otherwise(F.col("status")))


def broker_ancestors(brokers: DataFrame) -> DataFrame:
    """Parent and grandparent of each broker; a missing one is filled by the node itself."""
    up = brokers.select(
        F.col("id").alias("broker"),
        F.when(blank(F.col("parent_id")), F.col("id")).otherwise(F.col("parent_id")).alias("parent"),
    )
    grand = up.select(F.col("broker").alias("parent"), F.col("parent").alias("grandpa"))
    return up.join(grand, "parent", "left").select(
        "broker", "parent", F.coalesce("grandpa", "parent").alias("grandpa")
    )


def child_counts(brokers: DataFrame) -> DataFrame:
    """Number of direct children of each broker that has any."""
    return (
        brokers.where(F.col("parent_id").isNotNull())
        .groupBy(F.col("parent_id").alias("broker"))
        .agg(F.count(F.lit(1)).alias("children"))
    )


def broker_lines(ancestors: DataFrame, counts: DataFrame) -> DataFrame:
    """Ancestors of each broker with a flag whether they have enough children.

    Both lookups are done on the brokers, not on the orders, so they run once per
    broker however many orders it has.
    """
    able = counts.where(F.col("children") >= QUALIFYING_CHILDREN).select(F.col("broker").alias("able"))
    parents = able.select(F.col("able").alias("parent"), F.lit(True).alias("parent_able"))
    grandpas = able.select(F.col("able").alias("grandpa"), F.lit(True).alias("grandpa_able"))
    return (
        ancestors.join(parents, "parent", "left")
        .join(grandpas, "grandpa", "left")
        .select(
            "broker",
            "parent",
            "grandpa",
            F.coalesce("parent_able", F.lit(False)).alias("parent_able"),
            F.coalesce("grandpa_able", F.lit(False)).alias("grandpa_able"),
        )
    )


def profit_rules(schemes: DataFrame, items: DataFrame, category: str = DEFAULT_CATEGORY) -> DataFrame:
    """Share rules per platform; schemes without items give no rule."""
    used = schemes.where(F.col("category") == category).select(F.col("id").alias("scheme_id"), "platform")
    return used.join(items.withColumnRenamed("id", "scheme_item_id"), "scheme_id").select(
        "platform", "scheme_id", "scheme_item_id", "beneficiary", "beneficiary_type", "share"
    )


def attributed_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("broker_id").isNotNull())


def unattributed_orders(orders: DataFrame) -> DataFrame:
    """Taken orders without a broker: they get no clearing rows and stay in clearing."""
    return orders.where(F.col("broker_id").isNull())


def profit_amount(share: Column, commission: Column) -> Column:
    """Percent share of the commission at two digits, halves to the even cent."""
    part = F.coalesce(share.try_cast(SHARE), F.lit(0).cast(SHARE)) * commission.cast(MONEY)
    return F.bround(part * F.lit("0.01").cast("decimal(3,2)"), 2).cast(MONEY)


def clear_orders(
    orders: DataFrame,
    rules: DataFrame,
    ancestors: DataFrame,
    counts: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """One clearing row per order and share rule of its platform.

    Each order meets the broker table once.  Ids are digests of the order and rule, so a rerun
    gives the same ids.
    """
    lines = broker_lines(ancestors, counts).withColumnRenamed("broker", "broker_id")
    placed = attributed_orders(orders).join(lines, "broker_id", "left").select(
        orders["*"],
        F.coalesce("parent", "broker_id").alias("__parent"),
        F.coalesce("grandpa", "broker_id").alias("__grandpa"),
        F.coalesce("parent_able", F.lit(False)).alias("__parent_able"),
        F.coalesce("grandpa_able", F.lit(False)).alias("__grandpa_able"),
    )
    return share_out(with_rules(placed, rules), as_of)


def with_rules(placed: DataFrame, rules: DataFrame, platforms: DataFrame | None = None) -> DataFrame:
    """Each order with the rules of its platform.

    Platforms are few and hold all orders, so a join on them alone would be that many tasks.
    Orders are dealt out by their id within a platform, and the rules of ``platforms`` (all where none are
    named) are repeated for each share: few rows that Spark broadcasts, or shuffles as wide as the orders.
    """
    salts = max(LEAST_SALTS, int(rules.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if platforms is not None:
        rules = rules.join(platforms.select("platform").distinct(), "platform", "left_semi")
    copies = rules.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = placed.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    return dealt.join(copies, ["platform", "__salt"]).drop("__salt")


def share_out(shares: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Person, amount and state of each order-with-rule row."""
    name = F.col("beneficiary")
    is_team = F.coalesce(F.lower("beneficiary_type") == "team", F.lit(False))
    real = (
        F.when(name == "broker", F.col("broker_id"))
        .when(name == "parent", F.col("__parent"))
        .when(name == "grandpa", F.col("__grandpa"))
        .otherwise(F.concat(F.lit("null-"), name))
    )
    is_platform = F.lower(name) == "platform"
    person = F.when(is_team, name).when(is_platform, F.lit("platform")).otherwise(real)
    # An ancestor named in another letter case finds no real person and so has no children.
    unable = ((F.lower(name) == "parent") & ~((name == "parent") & F.col("__parent_able"))) | (
        (F.lower(name) == "grandpa") & ~((name == "grandpa") & F.col("__grandpa_able"))
    )
    state = F.when(is_team, F.lit("pending")).when(unable, F.lit("locked")).otherwise(F.lit("cleared"))
    stamp = F.current_timestamp() if as_of is None else as_of
    return shares.withColumn("__person", person).select(
        digest(
            F.col("id"),
            F.col("scheme_id"),
            F.col("scheme_item_id"),
            F.coalesce("beneficiary_type", F.lit("")),
            name,
            F.col("__person"),
        ).alias("id"),
        "platform",
        F.col("id").alias("order_id"),
        "order_time",
        "item",
        F.col("amount").alias("amount_order"),
        F.col("commission").alias("amount_commission"),
        profit_amount(F.col("share"), F.col("commission")).alias("amount_profit"),
        "scheme_id",
        "scheme_item_id",
        F.col("__person").alias("beneficiary"),
        "beneficiary_type",
        F.coalesce("share", F.lit("0")).alias("share"),
        state.alias("status_clear"),
        F.lit("pending").alias("status_settle"),
        stamp.alias("create_date"),
        stamp.alias("update_date"),
    )


def mark_cleared(orders: DataFrame, trace: DataFrame, rules: DataFrame) -> DataFrame:
    """The order table after clearing: taken orders with a broker and a rule are ``cleared``, others ``clearing``.

    Only pending orders meet the lookups; all others pass by without a shuffle.
    """
    pending = F.coalesce(F.col("status") == "pending", F.lit(False))
    owned = attributed_orders(trace).select(F.col("code").alias("trace_code"), "platform").distinct()
    ruled = rules.select("platform").distinct()
    done = owned.join(ruled, "platform", "left_semi").withColumn("__done", F.lit(True))
    taken = orders.where(pending).join(done, ["trace_code", "platform"], "left")
    state = F.when(F.col("__done"), F.lit("cleared")).otherwise(F.lit("clearing")).alias("status")
    moved = taken.select(*[state if c == "status" else F.col(c) for c in orders.columns])
    return orders.where(~pending).unionByName(moved)


def _payable(clearing: DataFrame, cutoff: Column | None, state: str) -> Column:
    due = (F.col("status_clear") == "cleared") & (F.col("status_settle") == state)
    return due if cutoff is None else due & (F.col("create_date") < cutoff)


def settlement_summary(clearing: DataFrame, items: DataFrame, cutoff: Column | None) -> DataFrame:
    """Sums of the payable rows by beneficiary, day and kind of share; all of them without a cutoff.

    Rows are summed by rule item before the item table is joined, so a beneficiary
    that holds a third of all rows reaches the second grouping as a few rows per day.
    """
    by_item = (
        clearing.where(_payable(clearing, cutoff, "pending"))
        .groupBy("beneficiary", F.to_date("create_date").alias("date"), "scheme_item_id")
        .agg(F.sum("amount_profit").alias("amount"))
    )
    kinds = items.select(F.col("id").alias("scheme_item_id"), F.col("beneficiary").alias("type"))
    return (
        by_item.join(kinds, "scheme_item_id", "left")
        .groupBy("beneficiary", "date", "type")
        .agg(
            F.min("scheme_item_id").alias("scheme_item_id"),
            F.count(F.lit(1)).alias("scheme_items"),
            F.sum("amount").cast("decimal(28,2)").alias("amount"),
        )
    )


def base_voucher(date: Column, type_: Column) -> Column:
    return F.concat(date.cast("string"), F.lit("-"), type_)


def voucher_month() -> Column:
    """The month of a settlement row's voucher, which begins with its day."""
    return F.substring("voucher", 1, 7)


def months_of(days: list[datetime.date]) -> list[str]:
    return sorted({day.strftime("%Y-%m") for day in days})


def unsettled_groups(summary: DataFrame) -> DataFrame:
    """Groups whose rule item has no kind: they get no voucher and their rows stay pending."""
    return summary.where(F.col("type").isNull())


def voucher_numbers(summary: DataFrame, settlements: DataFrame) -> DataFrame:
    """Voucher of each group: day and kind, with ``-n`` from the second one on.

    A group is unique by beneficiary, day and kind, so counting the vouchers it
    already has is enough to number it; groups without a kind are listed by
    ``unsettled_groups``.
    """
    known = (
        settlements.groupBy(
            F.col("broker_id").alias("beneficiary"),
            # the first ten characters of a voucher are its day
            F.concat(F.substring("voucher", 1, 10), F.lit("-"), F.col("type")).alias("__base"),
        )
        .agg(F.count(F.lit(1)).alias("__known"))
    )
    numbered = summary.where(F.col("type").isNotNull()).withColumn(
        "__base", base_voucher(F.col("date"), F.col("type"))
    )
    suffix = F.concat(F.lit("-"), (F.col("__known") + 1).cast("string"))
    return (
        numbered.join(known, ["beneficiary", "__base"], "left")
        .withColumn("voucher", F.concat("__base", F.coalesce(suffix, F.lit(""))))
        .drop("__base", "__known")
    )


def settle(vouchers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Settlement rows of numbered groups."""
    stamp = F.current_timestamp() if as_of is None else as_of
    return vouchers.select(
        digest(F.col("beneficiary"), F.lit("-"), F.col("voucher")).alias("id"),
        F.col("beneficiary").alias("broker_id"),
        "voucher",
        "type",
        "amount",
        F.lit("settled").alias("status"),
        stamp.alias("create_date"),
        stamp.alias("update_date"),
    )


def mark_settling(
    clearing: DataFrame, summary: DataFrame, items: DataFrame, cutoff: Column | None, as_of: Column | None = None
) -> DataFrame:
    """Payable rows of the summed groups go from ``pending`` to ``settling``.

    ``summary`` has one row per beneficiary, day and kind, as ``settlement_summary`` gives it.
    """
    return _move(clearing, summary, items, cutoff, "pending", "settling", as_of)


def mark_settled(
    clearing: DataFrame, summary: DataFrame, items: DataFrame, cutoff: Column | None, as_of: Column | None = None
) -> DataFrame:
    """Rows of the summed groups go from ``settling`` to ``settled``."""
    return _move(clearing, summary, items, cutoff, "settling", "settled", as_of)


def _move(
    clearing: DataFrame,
    summary: DataFrame,
    items: DataFrame,
    cutoff: Column | None,
    old: str,
    new: str,
    as_of: Column | None,
) -> DataFrame:
    # a row gets its kind from the item table, which is configuration, and meets the groups on their own key
    kinds = one_row_per_key(
        items.select(F.col("id").alias("scheme_item_id"), F.col("beneficiary").alias("__type")), ["scheme_item_id"]
    )
    groups = summary.where(F.col("type").isNotNull()).select(
        "beneficiary", F.col("date").alias("__day"), F.col("type").alias("__type"), F.lit(True).alias("__hit")
    )
    # rows that cannot move pass by: they are neither shuffled nor matched
    due = F.coalesce(_payable(clearing, cutoff, old), F.lit(False))
    flagged = clearing.where(due).withColumn("__day", F.to_date("create_date"))
    joined = flagged.join(kinds, "scheme_item_id", "left").join(groups, ["beneficiary", "__day", "__type"], "left")
    stamp = F.current_timestamp() if as_of is None else as_of
    values = {"status_settle": F.lit(new), "update_date": stamp}
    moved = joined.select(
        *[F.when(F.col("__hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in clearing.columns]
    )
    return clearing.where(~due).unionByName(moved)
