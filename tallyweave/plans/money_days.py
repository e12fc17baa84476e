"""Settlement over tables kept in parts by time: a run reads and rewrites the days it settles, no others.

``root``/clearing holds clearing rows by the day they were made, ``root``/settlements the
settlement rows, far fewer, by the month of their voucher and the run that made them.  Days and
months are as many as the calendar has: their list may reach the driver.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators.money import (
    mark_settled,
    mark_settling,
    months_of,
    settle,
    settlement_summary,
    unsettled_groups,
    voucher_month,
    voucher_numbers,
)
from tallyweave.operators.upsert import absent_from, one_row_per_key
from tallyweave.schemas import table_schema
from tallyweave.sources.parts import add_to_parts, finish_rewrite, read_parts, rewrite_parts
from tallyweave.sources.tables import stage

CLEARING_BY = ["day"]
SETTLEMENTS_BY = ["month", "run"]


def read_clearing(spark: SparkSession, root: str) -> DataFrame:
    """Clearing rows with their ``day``."""
    return read_parts(spark, f"{root}/clearing", table_schema("mod_clearing").add("day", "date"))


def read_settlements(spark: SparkSession, root: str) -> DataFrame:
    """Settlement rows with the ``month`` of their voucher and the ``run`` that made them."""
    layout = table_schema("mod_settlement").add("month", "string").add("run", "string")
    return read_parts(spark, f"{root}/settlements", layout)


def add_clearing(spark: SparkSession, root: str, new: DataFrame) -> None:
    """Add clearing rows whose id is not there yet, to the days they were made on.

    Of the rows that are there only the ids are read.
    """
    fresh = stage(one_row_per_key(new, ["id"]), "clearing")
    added = absent_from(fresh, read_clearing(spark, root), ["id"])
    add_to_parts(added.withColumn("day", F.to_date("create_date")), f"{root}/clearing", CLEARING_BY)


def add_settlements(root: str, rows: DataFrame, run: str) -> None:
    """Take over settlement rows made elsewhere; the same run again takes the place of what it made."""
    placed = rows.withColumns({"month": voucher_month(), "run": F.lit(run)})
    rewrite_parts(placed, f"{root}/settlements", SETTLEMENTS_BY)


def _days(rows: DataFrame) -> list[datetime.date]:
    return sorted(r["day"] for r in rows.select("day").distinct().collect() if r["day"] is not None)


def _on(days: list[datetime.date]) -> Column:
    return F.col("day").isin(days)


def run_name(as_of: datetime.datetime) -> str:
    """The name of a run: its moment, without what a folder's name cannot hold."""
    return as_of.strftime("%Y%m%dT%H%M%S")


def _moment(at: datetime.datetime) -> Column:
    """A moment as the session's time zone reads it, like those of the tables."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def settle_days(
    spark: SparkSession, root: str, items: DataFrame, cutoff: datetime.datetime, as_of: datetime.datetime
) -> DataFrame:
    """Settle what is payable before ``cutoff``; returns the groups that cannot be settled.

    ``as_of`` is the run's moment and names it.  Payable rows become ``settling`` in their
    days' parts, their groups are numbered after all vouchers of other runs and written, and
    then the rows become ``settled``.  Each step can be repeated: a run that was cut short is
    run again with the same ``as_of`` and gives the same rows, and until then no other run may start.
    """
    clearing_path = f"{root}/clearing"
    finish_rewrite(spark, clearing_path, CLEARING_BY)
    finish_rewrite(spark, f"{root}/settlements", SETTLEMENTS_BY)
    now, run, until = _moment(as_of), run_name(as_of), _moment(cutoff)
    clearing = read_clearing(spark, root)
    begun = F.col("status_settle") == "settling"
    other = clearing.where(begun & (F.col("update_date") != now)).select("update_date").first()
    if other is not None:
        raise RuntimeError(f"the run of {other['update_date']} has not ended: run it again first")

    before = F.col("day") <= F.lit(cutoff.date())
    payable = (F.col("status_clear") == "cleared") & (F.col("create_date") < until)
    open_ = clearing.where(before & payable & F.col("status_settle").isin("pending", "settling"))
    days = _days(open_)
    if not days:
        return unsettled_groups(settlement_summary(clearing.where(F.lit(False)), items, None))

    pending = settlement_summary(clearing.where(_on(days)), items, until)
    pending = stage(pending, "settlement-groups")
    touched = [d for d in days if d in {r["date"] for r in pending.where("type IS NOT NULL").select("date").distinct().collect()}]
    if touched:
        rows = clearing.where(_on(touched))
        rewrite_parts(mark_settling(rows, pending, items, until, now), clearing_path, CLEARING_BY)

    settling = read_clearing(spark, root).where(_on(days) & begun)
    groups = settlement_summary(settling.withColumn("status_settle", F.lit("pending")), items, None)
    groups = stage(groups, "settlement-groups")
    # only the months at hand are looked up, and never what this run itself made before
    known = read_settlements(spark, root).where(F.col("month").isin(months_of(days)) & (F.col("run") != run))
    add_settlements(root, settle(voucher_numbers(groups, known.drop("month", "run")), now), run)

    done = _days(settling)
    rows = read_clearing(spark, root).where(_on(done))
    rewrite_parts(mark_settled(rows, groups, items, None, now), clearing_path, CLEARING_BY)
    return unsettled_groups(pending)
