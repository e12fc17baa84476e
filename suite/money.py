"""Clearing and settlement queries."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from suite.fixtures import CUTOFF
from suite.registry import Tables, query
from tallyweave.operators import money
from tallyweave.plans import money_days
from tallyweave.session import shared_folder
from tallyweave.sources.tables import stage
from tallyweave.plans.money import clear_pending_orders, money_day, settle_cleared

def cutoff() -> Column:
    return F.lit(CUTOFF).cast("timestamp")


def clearing(t: Tables) -> DataFrame:
    return clear_pending_orders(
        t["mod_order"],
        t["mod_trace_code"],
        t["mod_broker"],
        t["mod_profit_share_scheme"],
        t["mod_profit_share_item"],
        F.col("order_time"),
    )


# What taking an order adds is its broker, looked up by code and platform together.
_TAKEN = """SELECT * EXCLUDE (status, commission_settlement), commission_settlement AS commission,
      (SELECT any_value(broker_id) FROM mod_trace_code c
       WHERE (c.code, c.platform) = (o.trace_code, o.platform)) AS broker_id
    FROM mod_order o WHERE status = 'pending'"""


@query("pending_orders", "mod_order mod_trace_code", _TAKEN)
def _(t: Tables) -> DataFrame:
    return money.pending_orders(t["mod_order"], t["mod_trace_code"])


@query("unattributed_orders", "mod_order mod_trace_code", f"SELECT * FROM ({_TAKEN}) x WHERE broker_id IS NULL")
def _(t: Tables) -> DataFrame:
    return money.unattributed_orders(money.pending_orders(t["mod_order"], t["mod_trace_code"]))


@query(
    "mark_clearing",
    "mod_order",
    """SELECT id, item, amount, order_time, platform, trace_code, commission_settlement,
       CASE WHEN status = 'pending' THEN 'clearing' ELSE status END AS status FROM mod_order""",
)
def _(t: Tables) -> DataFrame:
    return money.mark_clearing(t["mod_order"])


@query(
    "broker_ancestors",
    "mod_broker",
    """WITH up AS (SELECT id, coalesce(nullif(trim(parent_id), ''), id) AS parent FROM mod_broker)
    SELECT a.id AS broker, a.parent, coalesce(b.parent, a.parent) AS grandpa FROM up a LEFT JOIN up b ON b.id = a.parent""",
)
def _(t: Tables) -> DataFrame:
    return money.broker_ancestors(t["mod_broker"])


@query(
    "child_counts",
    "mod_broker",
    """SELECT parent_id AS broker, count(*) AS children FROM mod_broker WHERE parent_id IS NOT NULL GROUP BY parent_id""",
)
def _(t: Tables) -> DataFrame:
    return money.child_counts(t["mod_broker"])


@query(
    "profit_rules",
    "mod_profit_share_scheme mod_profit_share_item",
    """WITH used AS (SELECT id AS scheme_id, platform FROM mod_profit_share_scheme WHERE category = 'default'),
      parts AS (SELECT id AS scheme_item_id, * EXCLUDE (id) FROM mod_profit_share_item)
    SELECT * FROM used NATURAL JOIN parts""",
)
def _(t: Tables) -> DataFrame:
    return money.profit_rules(t["mod_profit_share_scheme"], t["mod_profit_share_item"])


@query("clear_orders", "mod_clearing", "SELECT * FROM mod_clearing")
def _(t: Tables) -> DataFrame:
    return clearing(t)


@query("clear_taken_orders", "mod_clearing", "SELECT * FROM mod_clearing")
def _(t: Tables) -> DataFrame:
    return money.clear_orders(
        money.pending_orders(t["mod_order"], t["mod_trace_code"]),
        money.profit_rules(t["mod_profit_share_scheme"], t["mod_profit_share_item"]),
        money.broker_ancestors(t["mod_broker"]),
        money.child_counts(t["mod_broker"]),
        F.col("order_time"),
    )


@query(
    "mark_cleared",
    "mod_order mod_trace_code mod_profit_share_scheme mod_profit_share_item",
    """SELECT a.id, a.item, a.amount, a.order_time, a.platform, a.trace_code, a.commission_settlement,
       CASE WHEN a.status <> 'pending' THEN a.status
            WHEN b.broker_id IS NOT NULL AND a.platform IN (
                SELECT s.platform FROM mod_profit_share_scheme s JOIN mod_profit_share_item i ON i.scheme_id = s.id
                WHERE s.category = 'default') THEN 'cleared'
            ELSE 'clearing' END AS status
    FROM mod_order a LEFT JOIN mod_trace_code b ON a.trace_code = b.code AND a.platform = b.platform""",
)
def _(t: Tables) -> DataFrame:
    rules = money.profit_rules(t["mod_profit_share_scheme"], t["mod_profit_share_item"])
    return money.mark_cleared(t["mod_order"], t["mod_trace_code"], rules)


def summary(t: Tables) -> DataFrame:
    return money.settlement_summary(clearing(t), t["mod_profit_share_item"], cutoff())


@query("settlement_summary", "settlement_groups", "SELECT * FROM settlement_groups")
def _(t: Tables) -> DataFrame:
    return summary(t)


_VOUCHERS = """SELECT g.*, CAST(g.date AS STRING) || '-' || g.type
         || CASE WHEN k.n > 0 THEN '-' || CAST(k.n + 1 AS STRING) ELSE '' END AS voucher
    FROM settlement_groups g LEFT JOIN (
      SELECT g2.beneficiary, g2.date, g2.type, count(*) AS n
      FROM settlement_groups g2 JOIN mod_settlement s ON s.broker_id = g2.beneficiary
        AND (s.voucher = CAST(g2.date AS STRING) || '-' || g2.type
             OR s.voucher LIKE CAST(g2.date AS STRING) || '-' || g2.type || '-%')
      GROUP BY g2.beneficiary, g2.date, g2.type
    ) k ON k.beneficiary = g.beneficiary AND k.date = g.date AND k.type = g.type
    WHERE g.type IS NOT NULL"""


@query("voucher_numbers", "settlement_groups mod_settlement", _VOUCHERS)
def _(t: Tables) -> DataFrame:
    return money.voucher_numbers(summary(t), t["mod_settlement"])


_SETTLED = f"""SELECT md5(beneficiary || '-' || voucher) AS id, beneficiary AS broker_id, voucher, type, amount,
       'settled' AS status, CAST('{CUTOFF}' AS TIMESTAMP) AS create_date, CAST('{CUTOFF}' AS TIMESTAMP) AS update_date
    FROM ({_VOUCHERS}) v"""


@query("settle", "settlement_groups mod_settlement", _SETTLED)
def _(t: Tables) -> DataFrame:
    return money.settle(money.voucher_numbers(summary(t), t["mod_settlement"]), cutoff())


@query("money_flow", "settlement_groups mod_settlement", _SETTLED)
def _(t: Tables) -> DataFrame:
    return settle_cleared(clearing(t), t["mod_profit_share_item"], t["mod_settlement"], cutoff(), cutoff())


# Moved rows carry the day of the move.
def _marked(state: str) -> str:
    due = f"status_clear = 'cleared' AND create_date < CAST('{CUTOFF}' AS TIMESTAMP)"
    return f"""SELECT * REPLACE (
         CASE WHEN {due} THEN '{state}' ELSE status_settle END AS status_settle,
         CASE WHEN {due} THEN CAST('{CUTOFF}' AS TIMESTAMP) ELSE update_date END AS update_date)
    FROM mod_clearing"""


def settled_groups(rows: DataFrame, t: Tables) -> DataFrame:
    return money.settlement_summary(rows, t["mod_profit_share_item"], cutoff())


@query("mark_settling", "mod_clearing", _marked("settling"))
def _(t: Tables) -> DataFrame:
    rows = stage(clearing(t), "clearing")
    return money.mark_settling(rows, settled_groups(rows, t), t["mod_profit_share_item"], cutoff(), cutoff())


@query("mark_settled", "mod_clearing", _marked("settled"))
def _(t: Tables) -> DataFrame:
    rows, items = stage(clearing(t), "clearing"), t["mod_profit_share_item"]
    groups = stage(settled_groups(rows, t), "settlement-groups")
    settling = money.mark_settling(rows, groups, items, cutoff(), cutoff())
    return money.mark_settled(settling, groups, items, cutoff(), cutoff())


# Rules gone from the item table leave groups without a kind.
@query(
    "unsettled_groups",
    "mod_clearing mod_profit_share_item",
    f"""SELECT beneficiary, CAST(create_date AS DATE) AS date, CAST(NULL AS VARCHAR) AS type,
         min(scheme_item_id) AS scheme_item_id, count(DISTINCT scheme_item_id) AS scheme_items,
         CAST(sum(amount_profit) AS DECIMAL(28,2)) AS amount
    FROM mod_clearing WHERE status_clear = 'cleared' AND create_date < CAST('{CUTOFF}' AS TIMESTAMP)
      AND scheme_item_id IN (SELECT id FROM mod_profit_share_item WHERE beneficiary = 'platform')
    GROUP BY beneficiary, CAST(create_date AS DATE)""",
)
def _(t: Tables) -> DataFrame:
    left = t["mod_profit_share_item"].where("beneficiary <> 'platform'")
    return money.unsettled_groups(money.settlement_summary(clearing(t), left, cutoff()))


# The clearing table of the day before holds the even orders, settled long ago; the day's run leaves them alone.
_DAY = f"""WITH day AS (SELECT * REPLACE (CAST('{CUTOFF}' AS TIMESTAMP) AS create_date, CAST('{CUTOFF}' AS TIMESTAMP) AS update_date)
    FROM mod_clearing)
    SELECT * REPLACE (CASE WHEN mod(CAST(order_id AS BIGINT), 2) = 0 OR status_clear = 'cleared' THEN 'settled'
        ELSE status_settle END AS status_settle) FROM day"""


def day(t: Tables) -> dict[str, DataFrame]:
    now = cutoff()
    market = [t[n] for n in "mod_order mod_trace_code mod_broker mod_profit_share_scheme mod_profit_share_item".split()]
    before = clear_pending_orders(*market, now).where("CAST(order_id AS BIGINT) % 2 = 0")
    known = before.withColumn("status_settle", F.lit("settled"))
    return money_day(*market, known, t["mod_settlement"], now + F.expr("INTERVAL 1 DAY"), now)


@query("money_day_clearing", "mod_clearing", _DAY)
def _(t: Tables) -> DataFrame:
    return day(t)["clearing"]


@query(
    "money_day_settlements",
    "mod_clearing mod_profit_share_item mod_settlement",
    f"""WITH due AS (SELECT c.beneficiary AS broker_id, k.beneficiary AS type, sum(amount_profit) AS amount
      FROM mod_clearing c JOIN mod_profit_share_item k ON k.id = c.scheme_item_id
      WHERE status_clear = 'cleared' AND mod(CAST(order_id AS BIGINT), 2) = 1 GROUP BY c.beneficiary, k.beneficiary),
    numbered AS (SELECT *, '{CUTOFF}-' || type AS first, (SELECT count(*) FROM mod_settlement s
        WHERE s.broker_id = due.broker_id AND s.type = due.type AND s.voucher LIKE '{CUTOFF}-%') AS known FROM due),
    named AS (SELECT *, CASE WHEN known = 0 THEN first ELSE first || '-' || CAST(known + 1 AS VARCHAR) END AS voucher FROM numbered)
    SELECT * FROM mod_settlement UNION ALL BY NAME
    SELECT md5(broker_id || '-' || voucher) AS id, broker_id, voucher, type, CAST(amount AS DECIMAL(28,2)) AS amount,
      'settled' AS status, CAST('{CUTOFF}' AS TIMESTAMP) AS create_date, CAST('{CUTOFF}' AS TIMESTAMP) AS update_date
    FROM named""",
)
def _(t: Tables) -> DataFrame:
    return day(t)["settlements"]


# --- tables kept by day ----------------------------------------------------------------------------------

# Orders are dated by quarter.  The even ones come first and are settled by the first run, a day later the others.
_RUNS = [datetime.datetime.fromisoformat(CUTOFF), datetime.datetime.fromisoformat(CUTOFF) + datetime.timedelta(days=1)]


def by_day(t: Tables) -> str:
    """The folder of the tables after both runs."""
    root, items = shared_folder(t.spark, "money"), t["mod_profit_share_item"]
    rows = stage(
        clear_pending_orders(
            t["mod_order"], t["mod_trace_code"], t["mod_broker"], t["mod_profit_share_scheme"], items,
            F.date_trunc("quarter", "order_time"),
        ),
        "clearing",
    )
    money_days.add_settlements(root, t["mod_settlement"], "before")
    for odd, as_of in enumerate(_RUNS):
        money_days.add_clearing(t.spark, root, rows.where(F.col("order_id").cast("bigint") % 2 <= odd))
        money_days.settle_days(t.spark, root, items, _RUNS[0], as_of)
    return root


_QUARTERS = f"""SELECT * REPLACE (date_trunc('quarter', create_date) AS create_date),
      status_clear = 'cleared' AND date_trunc('quarter', create_date) < CAST('{CUTOFF}' AS TIMESTAMP) AS due,
      mod(CAST(order_id AS BIGINT), 2) AS odd FROM mod_clearing"""


@query(
    "settle_days_clearing",
    "mod_clearing",
    f"""SELECT * EXCLUDE (due, odd) REPLACE (CAST(create_date AS TIMESTAMP) AS create_date,
      CASE WHEN due THEN 'settled' ELSE status_settle END AS status_settle,
      CASE WHEN due THEN CAST('{CUTOFF}' AS TIMESTAMP) + to_days(CAST(odd AS INT)) ELSE CAST(create_date AS TIMESTAMP) END AS update_date)
    FROM ({_QUARTERS}) q""",
)
def _(t: Tables) -> DataFrame:
    return money_days.read_clearing(t.spark, by_day(t)).drop("day")


@query(
    "settle_days_settlements",
    "mod_clearing mod_profit_share_item mod_settlement",
    f"""WITH quarters AS ({_QUARTERS}),
    sums AS (SELECT q.beneficiary AS broker_id, CAST(CAST(q.create_date AS DATE) AS VARCHAR) AS day, i.beneficiary AS type, odd,
        sum(amount_profit) AS amount
      FROM quarters q JOIN mod_profit_share_item i ON i.id = q.scheme_item_id WHERE due
      GROUP BY q.beneficiary, q.create_date, i.beneficiary, odd),
    known AS (SELECT broker_id, left(voucher, 10) AS day, type, count(*) AS n FROM mod_settlement GROUP BY ALL),
    numbered AS (SELECT s.*, coalesce(k.n, 0) + row_number() OVER (PARTITION BY s.broker_id, s.day, s.type ORDER BY odd) AS n
      FROM sums s LEFT JOIN known k USING (broker_id, day, type)),
    named AS (SELECT *, day || '-' || type || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS voucher,
        CAST('{CUTOFF}' AS TIMESTAMP) + to_days(CAST(odd AS INT)) AS moment FROM numbered)
    SELECT * FROM mod_settlement UNION ALL BY NAME
    SELECT md5(broker_id || '-' || voucher) AS id, broker_id, voucher, type, CAST(amount AS DECIMAL(28,2)) AS amount,
      'settled' AS status, moment AS create_date, moment AS update_date FROM named""",
)
def _(t: Tables) -> DataFrame:
    return money_days.read_settlements(t.spark, by_day(t)).drop("month", "run")
