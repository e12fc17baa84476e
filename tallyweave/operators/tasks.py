"""Task state: what to take next and how states change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.upsert import update_from

LEAF_PRIORITY = 900


def pending_batch(tasks: DataFrame, n: int, keys: list[str], leaf: bool | None = None) -> DataFrame:
    """The ``n`` pending tasks of highest priority, ties by key.

    ``leaf=True`` takes leaf tasks (priority 900 and above), ``leaf=False`` the others.
    """
    pending = tasks.where(F.col("status") == "pending")
    if leaf is not None:
        is_leaf = F.col("priority") >= LEAF_PRIORITY
        pending = pending.where(is_leaf if leaf else ~is_leaf)
    return pending.orderBy(F.desc("priority"), *keys).limit(n)


def pending_by_status(tasks: DataFrame, status: str, n: int, keys: list[str]) -> DataFrame:
    """The first ``n`` tasks in a state, in key order."""
    return tasks.where(F.col("status") == status).orderBy(*keys).limit(n)


def missing_id_batch(rows: DataFrame, col: str, also_present: list[str] | None = None) -> DataFrame:
    """Rows whose id ``col`` is still unknown, where the columns it depends on are known."""
    wanted = F.col(col).isNull()
    for c in also_present or []:
        wanted = wanted & F.col(c).isNotNull()
    return rows.where(wanted)


def restart_cycle(tasks: DataFrame, where: Column | None = None) -> DataFrame:
    """When no task of the group is pending, make all of them pending and bump the revision.

    The test is an uncorrelated EXISTS: it is run once, stops at the first pending
    row and reaches the tasks as a constant.
    """
    group = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    idle = ~tasks.where(group & (F.col("status") == "pending")).exists()
    restart = idle & group
    return tasks.select(
        *[
            F.when(restart, F.lit("pending")).otherwise(F.col(c)).alias(c)
            if c == "status"
            else (F.when(restart, F.col(c) + 1).otherwise(F.col(c)).alias(c) if c == "revision" else F.col(c))
            for c in tasks.columns
        ]
    )


def mark(tasks: DataFrame, batch: DataFrame, keys: list[str], status: str, bump: bool = True) -> DataFrame:
    """Put the tasks of the batch into a state, bumping their revision when asked."""
    taken = batch.select(*keys).distinct().withColumn("status", F.lit(status))
    also = {"revision": F.col("revision") + 1} if bump and "revision" in tasks.columns else {}
    return update_from(tasks, taken, keys, ["status"], also)
