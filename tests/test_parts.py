"""Tables kept in parts: what is touched, what stays, and runs that are cut short."""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyweave.operators import money, upsert
from tallyweave.plans import money_days
from tallyweave.schemas import table_schema
from tallyweave.sources import parts
from tallyweave.streaming import jobs

KEYS = ["property", "value", "userKey"]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, name, rows):
    return spark.createDataFrame(rows, table_schema(name))


def test_only_touched_parts_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    parts.add_to_parts(spark.range(40).selectExpr("id", "CAST(id % 4 AS INT) AS part"), path, ["part"])
    before = files(path)
    layout = spark.read.parquet(path).schema
    two = parts.read_parts(spark, path, layout).where("part = 2")
    parts.rewrite_parts(two.withColumn("id", F.col("id") + 100), path, ["part"])
    after = files(path)
    assert {f for f in before if "part=2" not in f} == {f for f in after if "part=2" not in f}
    assert not {f for f in before if "part=2" in f} & after
    assert rows(parts.read_parts(spark, path, layout).where("id >= 100"), "id") == sorted(((100 + i,) for i in range(2, 40, 4)), key=repr)
    assert not os.path.exists(f"{path}.rewrite")


def test_a_rewrite_that_was_cut_short_is_finished(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = spark.range(8).selectExpr("id", "CAST(id % 2 AS INT) AS part")
    parts.add_to_parts(frame, path, ["part"])
    replace = parts._replace
    monkeypatch.setattr(parts, "_replace", lambda *_: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(RuntimeError):
        parts.rewrite_parts(frame.where("part = 1").withColumn("id", F.lit(7)), path, ["part"])
    monkeypatch.setattr(parts, "_replace", replace)
    assert parts.finish_rewrite(spark, path, ["part"])
    assert rows(spark.read.parquet(path).where("part = 1"), "id") == [(7,)] * 4
    assert not parts.finish_rewrite(spark, path, ["part"])
    # rows that were not written down whole have touched nothing and are dropped
    os.makedirs(f"{path}.rewrite")
    assert not parts.finish_rewrite(spark, path, ["part"])
    assert spark.read.parquet(path).count() == 8


def test_no_table_yet(spark, tmp_path):
    layout = spark.range(1).schema
    assert parts.read_parts(spark, str(tmp_path / "none"), layout).collect() == []


def changes(spark, tmp_path, batch):
    layout = "userKey string, doc string"
    source = str(tmp_path / "in")
    spark.createDataFrame(batch, layout).write.mode("append").parquet(source)
    docs = spark.readStream.schema(layout).parquet(source)
    jobs.stream_property_upsert(
        jobs.flatten_documents(docs, ["userKey"]), KEYS, str(tmp_path / "out"), str(tmp_path / "check")
    ).awaitTermination()


def test_merging_changes_rewrites_their_buckets_only(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    assert jobs.compact_properties(spark, KEYS, out) == []
    users = [(f"u{i}", '{"a":1}') for i in range(50)]
    changes(spark, tmp_path, users)
    changes(spark, tmp_path, users[:1] + [(None, '{"a":2}')])
    assert len(jobs.compact_properties(spark, KEYS, out, 16)) > 8
    assert jobs.compact_properties(spark, KEYS, out, 16) == []
    before = files(f"{out}/base")
    changes(spark, tmp_path, [("u3", '{"a":1}'), (None, '{"a":2}')])
    unmerged = rows(jobs.current_properties(spark, KEYS, out), "userKey", "revision", "status")
    touched = jobs.compact_properties(spark, KEYS, out, 16)
    assert 1 <= len(touched) <= 2
    stayed = {f for f in before if not any(f"bucket={b}{os.sep}" in f for b in touched)}
    assert stayed and stayed <= files(f"{out}/base")
    merged = rows(jobs.current_properties(spark, KEYS, out), "userKey", "revision", "status")
    expected = {f"u{i}": 1 for i in range(50)} | {"u0": 2, "u3": 2, None: 2}
    assert unmerged == merged == sorted([(u, n, "pending") for u, n in expected.items()], key=repr)
    assert not files(f"{out}/changes")


def test_what_was_merged_is_not_grouped_again(spark, tmp_path):
    out = str(tmp_path / "out")
    changes(spark, tmp_path, [("u1", '{"a":1}')])
    jobs.compact_properties(spark, KEYS, out, 4)
    changes(spark, tmp_path, [("u1", '{"a":1}')])
    plan = jobs.current_properties(spark, KEYS, out)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    grouped = [i for i, line in enumerate(plan) if "Aggregate" in line]
    assert grouped
    for at in grouped:
        below = next(line for line in plan[at:] if "Relation" in line)
        assert "batch_id" in below and "bucket" not in below


def test_bumps_in_parts(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    layout = spark.createDataFrame([], "k string, status string, revision int").schema
    first = spark.createDataFrame([(f"k{i}", "new") for i in range(30)] + [("k1", "new"), (None, "new")], "k string, status string")
    upsert.bump_in_parts(spark, path, layout, first, ["k"], buckets=8)
    before = files(path)
    again = spark.createDataFrame([("k1", "other"), ("k1", "other"), (None, "other"), ("more", "other")], "k string, status string")
    touched = upsert.bump_in_parts(spark, path, layout, again, ["k"], buckets=8)
    stayed = {f for f in before if not any(f"bucket={b}{os.sep}" in f for b in touched)}
    assert len(touched) <= 3 and stayed <= files(path)
    expected = {f"k{i}": 1 for i in range(30)} | {"k1": 4, None: 2}
    found = rows(spark.read.schema(layout).parquet(path), "k", "status", "revision")
    assert found == sorted([(k, "new", n) for k, n in expected.items()] + [("more", "other", 1)], key=repr)
    assert upsert.bump_in_parts(spark, path, layout, again.limit(0), ["k"]) == []


# --- settlement by day -----------------------------------------------------------------------------------

NOON = datetime.datetime(2024, 1, 1, 12)
CUTOFF = datetime.datetime(2024, 1, 20)


def clearing(spark, rows):
    base = ("p1", "o", NOON, "it", Decimal(1), Decimal(1))
    full = [
        (name, *base, Decimal(amount), "s", item, who, "person", "1", "cleared", "pending", NOON + datetime.timedelta(days=day), NOON)
        for name, who, item, amount, day in rows
    ]
    return table(spark, "mod_clearing", full)


@pytest.fixture
def items(spark):
    return table(spark, "mod_profit_share_item", [("i1", "s", "broker", "p", "1"), ("i2", "s", "platform", "p", "1")])


def vouchers(spark, root):
    return {(r["voucher"], r["amount"]) for r in money_days.read_settlements(spark, root).collect()}


def test_a_run_rewrites_its_days_only(spark, rows, tmp_path, items):
    root = str(tmp_path)
    money_days.add_clearing(spark, root, clearing(spark, [("a", "b", "i1", 1, 0), ("b", "b", "i2", 2, 1), ("c", "b", "i1", 4, 30)]))
    money_days.settle_days(spark, root, items, CUTOFF, CUTOFF)
    first = files(f"{root}/clearing")
    assert vouchers(spark, root) == {("2024-01-01-broker", 1), ("2024-01-02-platform", 2)}
    # another row of the second day, one known already, and one whose rule is gone
    late = [("a", "b", "i1", 1, 0), ("d", "b", "i2", 8, 1), ("e", "b", "gone", 16, 2)]
    money_days.add_clearing(spark, root, clearing(spark, late))
    second = files(f"{root}/clearing")
    assert first < second
    left = money_days.settle_days(spark, root, items, CUTOFF, CUTOFF + datetime.timedelta(days=1))
    assert rows(left, "scheme_item_id", "amount") == [("gone", Decimal(16))]
    third = files(f"{root}/clearing")
    assert {f for f in second if "day=2024-01-02" not in f} <= third
    assert not {f for f in second if "day=2024-01-02" in f} & third
    assert ("2024-01-02-platform-2", 8) in vouchers(spark, root)
    states = {r["id"]: (r["status_settle"], r["update_date"]) for r in money_days.read_clearing(spark, root).collect()}
    assert states == {
        "a": ("settled", CUTOFF),
        "b": ("settled", CUTOFF),
        "c": ("pending", NOON),
        "d": ("settled", CUTOFF + datetime.timedelta(days=1)),
        "e": ("pending", NOON),
    }
    # nothing is due: nothing is written
    money_days.settle_days(spark, root, items, CUTOFF, CUTOFF + datetime.timedelta(days=2))
    assert files(f"{root}/clearing") == third


@pytest.mark.parametrize("step", ["add_settlements", "mark_settled", "settle"])
def test_a_run_cut_short_is_run_again_and_pays_once(spark, tmp_path, items, monkeypatch, step):
    root = str(tmp_path)
    money_days.add_clearing(spark, root, clearing(spark, [("a", "b", "i1", 1, 0), ("b", "b", "i2", 2, 1)]))
    own = getattr(money_days, step)
    monkeypatch.setattr(money_days, step, lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        money_days.settle_days(spark, root, items, CUTOFF, CUTOFF)
    monkeypatch.setattr(money_days, step, own)
    with pytest.raises(RuntimeError, match="has not ended"):
        money_days.settle_days(spark, root, items, CUTOFF, CUTOFF + datetime.timedelta(days=1))
    # a row that comes in between joins the run that is repeated
    money_days.add_clearing(spark, root, clearing(spark, [("c", "b", "i1", 4, 0)]))
    money_days.settle_days(spark, root, items, CUTOFF, CUTOFF)
    assert vouchers(spark, root) == {("2024-01-01-broker", 5), ("2024-01-02-platform", 2)}
    assert {r["status_settle"] for r in money_days.read_clearing(spark, root).collect()} == {"settled"}


def test_lookups_of_vouchers_open_their_months_only(spark, tmp_path):
    path = str(tmp_path)
    rows = table(spark, "mod_settlement", [("x", "b", f"2024-{m:02d}-01-broker", "broker", Decimal(1), "settled", NOON, NOON) for m in (1, 2, 3)])
    placed = rows.withColumns({"month": money.voucher_month(), "batch_id": F.lit(0)})
    parts.add_to_parts(placed, f"{path}/settlements", ["month", "batch_id"])
    found = jobs.earlier_settlements(spark, path, 1, ["2024-02"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    condition = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "month" in condition and "batch_id" in condition
    assert [r["voucher"] for r in found.collect()] == ["2024-02-01-broker"]
    assert jobs.earlier_settlements(spark, path, 0).collect() == []


def test_moving_rows_multiplies_no_groups(spark, items):
    """Groups meet rows on their own key: many rule items of a kind make no more rows."""
    many = items.union(table(spark, "mod_profit_share_item", [(f"x{i}", "s", "broker", "p", "1") for i in range(200)]))
    rows = clearing(spark, [(str(n), f"b{n % 7}", f"x{n % 200}", 1, n % 3) for n in range(300)])
    cutoff = F.lit(CUTOFF)
    summary = money.settlement_summary(rows, many, cutoff)
    settling = money.mark_settling(rows, summary, many, cutoff)
    assert settling.where("status_settle = 'settling'").count() == 300
    plan = settling._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "[type#" not in plan.split("Join LeftOuter")[0]


# --- rows that wait --------------------------------------------------------------------------------------


def test_rows_wait_for_their_label_and_none_is_lost(spark, rows, tmp_path):
    layout = "property string, value string, userKey string, score decimal(18,6), rank int, status string"
    labels_layout = "property string, value string, score decimal(18,6), rank int, status string"
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def run(new_rows, new_labels):
        for folder, new, kind in (("rows", new_rows, layout), ("labels", new_labels, labels_layout)):
            spark.createDataFrame(new, kind).write.mode("append").parquet(str(tmp_path / folder))
        streams = [spark.readStream.schema(k).parquet(str(tmp_path / f)) for f, k in (("rows", layout), ("labels", labels_layout))]
        query = jobs.stream_normalize(*streams, ["property", "value"], out, checkpoint)
        query.awaitTermination()
        return query

    def waiting(name, label):
        return ("p", label, name, None, None, "pending")

    def label(value, state):
        return ("p", value, Decimal(2), 3, state)

    first = run([waiting("u1", "a"), waiting("u2", "b"), waiting("u3", None)], [label("a", "ready"), label("b", "pending")])
    assert rows(spark.read.parquet(out), "userKey", "rank", "status") == [("u1", 3, "ready")]
    size = jobs.state_size(first)
    assert sum(s["rows"] for s in size if "join" in s["step"].lower()) >= 3 and all(s["bytes"] >= 0 for s in size)
    run([waiting("u4", "b"), waiting("u5", "a")], [label("c", "ready")])
    assert rows(spark.read.parquet(out), "userKey") == [("u1",), ("u5",)]
    run([], [label("b", "ready"), label("a", "ready")])
    found = spark.read.parquet(out)
    assert rows(found, "userKey", "status") == [(u, "ready") for u in ("u1", "u2", "u4", "u5")]
    assert found.columns == [c.split(" ")[0] for c in layout.split(", ")]


def test_a_null_in_a_key_is_a_value(spark, rows):
    target = spark.createDataFrame([("a", None, "old", 1), (None, None, "old", 1)], "x string, y string, status string, revision int")
    new = spark.createDataFrame([("a", None), (None, None), (None, "y")], "x string, y string").withColumn("status", F.lit("new"))
    out = upsert.insert_or_bump_revision(target, new, ["x", "y"])
    expected = sorted([("a", None, "old", 2), (None, None, "old", 2), (None, "y", "new", 1)], key=repr)
    assert rows(out, "x", "y", "status", "revision") == expected
    kept = upsert.insert_ignore(target, new.withColumn("revision", F.lit(9)), ["x", "y"])
    assert rows(kept, "x", "y", "revision") == sorted([("a", None, 1), (None, None, 1), (None, "y", 9)], key=repr)
