"""Domain tables derived from the driver's tables.

Each view is one SQL text that Spark and DuckDB both read; only literals, list
expansion and unpivoting are spelled per dialect.  The Spark side reads the views as
common table expressions over the Parquet files, the oracle puts the same
expressions in front of its own SQL.  Small configuration tables are literals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK, DUCK = "spark", "duckdb"


@dataclass(frozen=True)
class View:
    deps: tuple[str, ...]
    text: str | Callable[[str], str]

    def sql(self, dialect: str) -> str:
        return self.text if isinstance(self.text, str) else self.text(dialect)


VIEWS: dict[str, View] = {}


def view(name: str, deps: str, text: str | Callable[[str], str]) -> None:
    VIEWS[name] = View(tuple(deps.split()), text)


def needed(names: list[str]) -> list[str]:
    """The views to define, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or name in BASE:
            return
        for dep in VIEWS[name].deps:
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    return order


def with_views(names: list[str], select: str) -> str:
    """Oracle SQL: the views in front of a select."""
    parts = [f"{n} AS ({VIEWS[n].sql(DUCK)})" for n in needed(names)]
    body = select.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)},\n{body[5:]}"
    return f"WITH {', '.join(parts)}\n{body}"


# Views make several rows of each row of these narrow tables.  Their files are small and few tasks would scan them, so
# the rows are spread by key before they become many: else a task's share grows with the table.
SPREAD = {"customer": "c_custkey", "part": "p_partkey"}


def _scan(spark: SparkSession, sf_dir: str, base: str) -> str:
    hint = ""
    if base in SPREAD:
        # a stated number, as Spark would join tasks by the bytes they have before the rows become many
        tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        hint = f"/*+ REPARTITION({tasks}, {SPREAD[base]}) */ "
    return f"SELECT {hint}* FROM parquet.`{sf_dir}/{base}.parquet`"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a view as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    order = needed([name])
    base = sorted({d for n in order for d in VIEWS[n].deps if d in BASE})
    parts = [f"{b} AS ({_scan(spark, sf_dir, b)})" for b in base]
    parts += [f"{n} AS ({VIEWS[n].sql(SPARK)})" for n in order]
    return spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}")


def over(spark: SparkSession, source: DataFrame, base: str, name: str) -> DataFrame:
    """A view computed over another source for its one base table, such as a stream."""
    source.createOrReplaceTempView(f"stream_of_{base}")
    order = needed([name])
    parts = [f"{base} AS (SELECT * FROM stream_of_{base})"]
    parts += [f"{n} AS ({VIEWS[n].sql(SPARK)})" for n in order]
    return spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}")


def _literal(value, dialect: str) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    escape = "\\'" if dialect == SPARK else "''"
    return "'" + str(value).replace("'", escape) + "'"


def values(name: str, columns: str, rows: list[tuple]) -> None:
    """A literal table; ``columns`` is a list of ``name type``."""
    cols = [c.strip().split(" ", 1) for c in columns.split(";")]

    def text(dialect: str) -> str:
        names = ", ".join(c for c, _ in cols)
        casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in cols)
        body = ", ".join("(" + ", ".join(_literal(v, dialect) for v in row) + ")" for row in rows)
        return f"SELECT {casts} FROM (VALUES {body}) AS t({names})"

    view(name, "", text)


def numbered(table: str, n: int) -> Callable[[str], str]:
    """Each row of a table ``n`` times, with ``i`` from 1."""
    return lambda dialect: (
        f"SELECT *, explode(sequence(1, {n})) AS i FROM {table}"
        if dialect == SPARK
        else f"SELECT *, unnest(range(1, {n} + 1)) AS i FROM {table}"
    )


# --- money -----------------------------------------------------------------------------------------------

view(
    "mod_order",
    "orders",
    """SELECT CAST(o_orderkey AS STRING) AS id,
       'part-' || CAST(mod(o_orderkey, 2000) AS STRING) AS item,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       o_orderdate AS order_time,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'p1'
            WHEN o_orderpriority = '5-LOW' THEN 'p3' ELSE 'p2' END AS platform,
       CAST(o_custkey AS STRING) AS trace_code,
       CAST(CAST(round(o_totalprice * 5) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS commission_settlement,
       CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'cleared' ELSE 'closed' END AS status
    FROM orders""",
)
view("customer_platform", "customer", numbered("customer", 3))
view(
    "mod_trace_code",
    "customer_platform",
    """SELECT CAST(c_custkey AS STRING) AS code, 'p' || CAST(i AS STRING) AS platform,
       CAST(c_custkey AS STRING) AS broker_id
    FROM customer_platform WHERE mod(c_custkey, 13) <> 0""",
)
view(
    "mod_broker",
    "customer",
    """SELECT CAST(c_custkey AS STRING) AS id,
       CASE WHEN c_custkey < 10 THEN NULL
            WHEN c_custkey < 20 THEN ' '
            WHEN mod(c_custkey, 2) = 0 THEN CAST(CAST(floor(c_custkey / 40) AS BIGINT) AS STRING)
            ELSE CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING) END AS parent_id
    FROM customer""",
)
# Every supplier is a scheme; the first ones stand for the platforms that orders come from.
view(
    "mod_profit_share_scheme",
    "supplier",
    """SELECT 's' || CAST(s_suppkey AS STRING) AS id,
       CASE WHEN s_suppkey = 3 OR mod(s_suppkey, 5) = 0 THEN 'special' ELSE 'default' END AS category,
       CASE s_suppkey WHEN 2 THEN 'p2' WHEN 4 THEN 'p3' WHEN 1 THEN 'p1' WHEN 3 THEN 'p1'
         ELSE 'shop-' || CAST(s_nationkey AS STRING) END AS platform
    FROM supplier""",
)
values(
    "order_rules",
    "id STRING; scheme_id STRING; beneficiary STRING; beneficiary_type STRING; share STRING",
    [
        ("i1", "s1", "broker", "person", "60"),
        ("i2", "s1", "parent", "person", "15"),
        ("i3", "s1", "grandpa", "person", "5"),
        ("i4", "s1", "team-a", "team", "10"),
        ("i5", "s1", "platform", "person", "4.5"),
        ("i6", "s1", "mentor", "person", "5"),
        ("i7", "s1", "Parent", "person", "0.5"),
        ("i8", "s2", "broker", "person", "70"),
        ("i9", "s2", "platform", "person", "30"),
        ("i10", "s2", "parent", "person", "none"),
        ("i11", "s2", "broker", "person", "1.25"),
        ("i12", "s3", "broker", "person", "99"),
    ],
)
# Other suppliers share with the broker by their balance.
view(
    "mod_profit_share_item",
    "order_rules supplier",
    """SELECT id, scheme_id, beneficiary, beneficiary_type, share FROM order_rules
    UNION ALL
    SELECT 'j' || CAST(s_suppkey AS STRING), 's' || CAST(s_suppkey AS STRING), 'broker', 'person',
       CAST(CAST(mod(CAST(floor(abs(s_acctbal)) AS BIGINT), 90) AS BIGINT) AS STRING)
    FROM supplier WHERE s_suppkey > 4""",
)
view(
    "mod_clearing",
    "mod_order mod_trace_code mod_broker mod_profit_share_scheme mod_profit_share_item",
    """SELECT md5(id || scheme_id || scheme_item_id || beneficiary_type || name || person) AS id, platform,
       id AS order_id, order_time, item, amount AS amount_order, commission AS amount_commission,
       CAST((units - mod(units, 1000000)) / 1000000
            + CASE WHEN mod(units, 1000000) > 500000 THEN 1
                   WHEN mod(units, 1000000) = 500000 AND mod((units - 500000) / 1000000, 2) = 1 THEN 1
                   ELSE 0 END AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS amount_profit,
       scheme_id, scheme_item_id, person AS beneficiary, beneficiary_type, share,
       CASE WHEN beneficiary_type = 'team' THEN 'pending'
            WHEN name = 'Parent' THEN 'locked'
            WHEN name = 'parent' AND coalesce(parent_children, 0) < 15 THEN 'locked'
            WHEN name = 'grandpa' AND coalesce(grandpa_children, 0) < 15 THEN 'locked'
            ELSE 'cleared' END AS status_clear,
       'pending' AS status_settle, order_time AS create_date, order_time AS update_date
    FROM (
      SELECT o.*, r.id AS scheme_item_id, r.scheme_id, r.beneficiary AS name, r.beneficiary_type, r.share,
             CAST(CASE WHEN r.share = 'none' THEN 0 ELSE CAST(r.share AS DECIMAL(9,4)) END * 10000 AS BIGINT)
               * CAST(o.commission * 100 AS BIGINT) AS units,
             CASE WHEN r.beneficiary_type = 'team' THEN r.beneficiary
                  WHEN r.beneficiary = 'platform' THEN 'platform'
                  WHEN r.beneficiary = 'broker' THEN o.broker_id
                  WHEN r.beneficiary = 'parent' THEN o.parent
                  WHEN r.beneficiary = 'grandpa' THEN o.grandpa
                  ELSE 'null-' || r.beneficiary END AS person
      FROM (
        SELECT q.*, cp.n AS parent_children, cg.n AS grandpa_children
        FROM (
          SELECT a.id, a.item, a.amount, a.order_time, a.platform, a.commission_settlement AS commission,
                 t.broker_id, coalesce(nullif(trim(b.parent_id), ''), t.broker_id) AS parent,
                 coalesce(nullif(trim(g.parent_id), ''), nullif(trim(b.parent_id), ''), t.broker_id) AS grandpa
          FROM mod_order a
          JOIN mod_trace_code t ON a.trace_code = t.code AND a.platform = t.platform
          LEFT JOIN mod_broker b ON b.id = t.broker_id
          LEFT JOIN mod_broker g ON g.id = coalesce(nullif(trim(b.parent_id), ''), t.broker_id)
          WHERE a.status = 'pending'
        ) q
        LEFT JOIN (SELECT parent_id, count(*) AS n FROM mod_broker GROUP BY parent_id) cp ON cp.parent_id = q.parent
        LEFT JOIN (SELECT parent_id, count(*) AS n FROM mod_broker GROUP BY parent_id) cg ON cg.parent_id = q.grandpa
      ) o
      JOIN mod_profit_share_scheme s ON s.platform = o.platform AND s.category = 'default'
      JOIN mod_profit_share_item r ON r.scheme_id = s.id
    ) x""",
)
CUTOFF = "2001-01-01"
# Payable clearing rows by person, day and kind of share.
view(
    "settlement_groups",
    "mod_clearing mod_profit_share_item",
    f"""SELECT beneficiary, date, type, min(scheme_item_id) AS scheme_item_id, count(*) AS scheme_items,
       CAST(sum(amount) AS DECIMAL(28,2)) AS amount
    FROM (
      SELECT c.beneficiary, CAST(c.create_date AS DATE) AS date, c.scheme_item_id, sum(c.amount_profit) AS amount
      FROM mod_clearing c
      WHERE c.create_date < CAST('{CUTOFF}' AS TIMESTAMP) AND c.status_settle = 'pending' AND c.status_clear = 'cleared'
      GROUP BY c.beneficiary, CAST(c.create_date AS DATE), c.scheme_item_id
    ) by_item
    LEFT JOIN (SELECT id AS rule, beneficiary AS type FROM mod_profit_share_item) kinds ON rule = scheme_item_id
    GROUP BY beneficiary, date, type""",
)
# Settlements that exist already: every broker has settled some of its days once, some twice.
view(
    "mod_settlement",
    "orders",
    """SELECT id, broker_id, voucher, type, amount, status, create_date, update_date FROM (
      SELECT md5(CAST(o_custkey AS STRING) || '-' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '-broker') AS id,
         CAST(o_custkey AS STRING) AS broker_id, CAST(CAST(o_orderdate AS DATE) AS STRING) || '-broker' AS voucher,
         'broker' AS type, CAST(1 AS DECIMAL(28,2)) AS amount, 'settled' AS status,
         o_orderdate AS create_date, o_orderdate AS update_date
      FROM orders WHERE o_orderstatus = 'P' AND mod(o_orderkey, 4) < 2
      UNION ALL
      SELECT md5(CAST(o_custkey AS STRING) || '-' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '-broker-2'),
         CAST(o_custkey AS STRING), CAST(CAST(o_orderdate AS DATE) AS STRING) || '-broker-2',
         'broker', CAST(2 AS DECIMAL(28,2)), 'settled', o_orderdate, o_orderdate
      FROM orders WHERE o_orderstatus = 'P' AND mod(o_orderkey, 4) = 1
    ) s""",
)

# --- documents -------------------------------------------------------------------------------------------

view(
    "item_docs",
    "part",
    """SELECT CAST(p_partkey AS STRING) AS _key, p_type AS category,
       '{"title":"' || p_name || '","brand":"' || p_brand || '","price":{"sale":' || CAST(p_retailprice AS STRING)
         || '},"props":[{"k":"size","v":' || CAST(p_size AS STRING) || '}],"tags":["' || p_type || '","' || p_brand
         || '"],"tagging":' || CASE WHEN mod(p_partkey, 2) = 1 THEN 'null' ELSE '"' || p_name || '"' END || '}' AS doc,
       CASE WHEN mod(p_partkey, 2) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CASE mod(p_partkey, 3) WHEN 0 THEN NULL WHEN 1 THEN 'pending' ELSE 'ready' END AS "index"
    FROM part""".replace('"index"', "index"),
)
view(
    "user_docs",
    "customer",
    """SELECT CAST(c_custkey AS STRING) AS _key,
       '{"name":"' || c_name || '","segment":"' || c_mktsegment || '","account":{"balance":' || CAST(c_acctbal AS STRING)
         || '},"nation":' || CAST(c_nationkey AS STRING) || '}' AS doc,
       CASE WHEN mod(c_custkey, 2) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CASE WHEN mod(c_custkey, 3) = 0 THEN NULL ELSE true END AS isRecommend,
       'query-' || CAST(c_custkey AS STRING) AS query, c_mktsegment AS tags
    FROM customer""",
)
view(
    "persona_docs",
    "supplier",
    """SELECT CAST(s_suppkey AS STRING) AS _key, 'query-' || s_name AS query, CAST(s_nationkey AS STRING) AS tags,
       CASE WHEN mod(s_suppkey, 2) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CASE WHEN mod(s_suppkey, 3) = 0 THEN NULL ELSE true END AS isRecommend
    FROM supplier""",
)
view("event_docs", "events", "SELECT CAST(event_id AS STRING) AS _key, props AS doc FROM events")

view("user_event_docs", "events", "SELECT CAST(user_id AS STRING) AS userKey, props AS doc FROM events")
view(
    "order_payments",
    "orders",
    """SELECT CAST(o_custkey AS STRING) AS beneficiary, CASE WHEN o_orderstatus = 'P' THEN 'i1' ELSE 'i9' END AS scheme_item_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount_profit, CAST(o_orderdate AS TIMESTAMP) AS create_date,
       CASE WHEN o_orderstatus = 'F' THEN 'locked' ELSE 'cleared' END AS status_clear, 'pending' AS status_settle
    FROM orders""",
)


def _unpivot(table: str, keep: str, pairs: list[tuple[str, str]]) -> Callable[[str], str]:
    def text(dialect: str) -> str:
        if dialect == SPARK:
            items = ", ".join(f"'{p}', {e}" for p, e in pairs)
            return f"SELECT stack({len(pairs)}, {items}) AS (property, value), {keep} FROM {table}"
        return " UNION ALL ".join(f"SELECT '{p}' AS property, {e} AS value, {keep} FROM {table}" for p, e in pairs)

    return text


ITEM_PAIRS = [
    ("title", "p_name"),
    ("brand", "p_brand"),
    ("price.sale", "CAST(p_retailprice AS STRING)"),
    ("props.0.k", "'size'"),
    ("props.0.v", "CAST(p_size AS STRING)"),
    ("tags", "'[' || p_type || ', ' || p_brand || ']'"),
    ("tagging", "CASE WHEN mod(p_partkey, 2) = 1 THEN 'null' ELSE p_name END"),
]
USER_PAIRS = [
    ("name", "c_name"),
    ("segment", "c_mktsegment"),
    ("account.balance", "CAST(c_acctbal AS STRING)"),
    ("nation", "CAST(c_nationkey AS STRING)"),
]
view("item_flat", "part", _unpivot("part", "p_type AS category, CAST(p_partkey AS STRING) AS itemKey", ITEM_PAIRS))
view("user_flat", "customer", _unpivot("customer", "CAST(c_custkey AS STRING) AS userKey", USER_PAIRS))

# --- labels ----------------------------------------------------------------------------------------------

RANK = "CAST(1 + mod(ascii(value) + 3 * length(value) + 7 * ascii(substr(value, length(value), 1)), 10) AS INT)"
_LABEL = """CAST(rank * CAST(0.083 AS DECIMAL(4,3)) AS DECIMAL(18,6)) AS score, rank,
       CASE WHEN mod(rank, 2) = 0 THEN 'ready' ELSE 'pending' END AS status, 1 AS revision"""
view(
    "item_value",
    "item_flat",
    f"""SELECT category, property, value, {_LABEL}
    FROM (SELECT DISTINCT category, property, value, {RANK} AS rank FROM item_flat) v""",
)
view(
    "user_value",
    "user_flat",
    f"""SELECT property, value, {_LABEL}
    FROM (SELECT DISTINCT property, value, {RANK} AS rank FROM user_flat) v""",
)

# --- item configuration ----------------------------------------------------------------------------------

_CATEGORIES = [
    ("c1", "STANDARD", "m1", "o1,o2,o3", "t1"),
    ("c2", "MEDIUM", "m2,m4,m5", "", "t2"),
    ("c3", "PROMO", None, "o4", "t1"),
    ("c4", "LARGE", "m3,m9", "o2", "t2"),
    ("c5", "SMALL", "", None, "t1"),
    ("c6", "CLEARANCE", "m1", "o1", "t2"),
]
values(
    "category_tree",
    "id STRING; name STRING; motivation_ids STRING; occasion_ids STRING; tree STRING",
    _CATEGORIES,
)


def per_category(nodes: list[tuple], row: Callable[[str, tuple], tuple]) -> list[tuple]:
    """The rows of each category's own copy of its tree; ids carry the category in front."""
    return [row(c, n[1:]) for c, *_, tree in _CATEGORIES for n in nodes if n[0] == tree]


def _inside(category: str, node: str) -> str:
    return node if node == "0" else f"{category}-{node}"


view("mod_item_category", "category_tree", "SELECT id, name, motivation_ids, occasion_ids FROM category_tree")
_TREE = [
    ("t1", "r", "0", "0,", "1"),
    ("t1", "a", "r", "0,r,", "0.5"),
    ("t1", "b", "r", "0,r", "0.3"),
    ("t1", "c", "r", "0,r,", "0.2"),
    ("t1", "a1", "a", "0,r,a,", "0.6"),
    ("t1", "a2", "a", "0,r,a", "0.4"),
    ("t1", "b1", "b", "0,r,b,", "0.7"),
    ("t1", "b2", "b", "0,r,b", "0.3"),
    ("t1", "b21", "b2", "0,r,b,b2,,", "0.5"),
    ("t1", "b22", "b2", "0,r,b,b2", "0.5"),
    ("t1", "c1", "c", "0,r,c", "1"),
    ("t2", "r", "0", "0,", "1"),
    ("t2", "a", "r", "0,r,", "0.45"),
    ("t2", "b", "r", "0,r,", "0.55"),
]
_TREE_MAP = [
    ("t1", "a1", "title", "0.5"),
    ("t1", "a1", "brand", "0.25"),
    ("t1", "a2", "price.sale", "0.4"),
    ("t1", "b1", "props.0.v", "0.7"),
    ("t1", "b2", "brand", "0.3"),
    ("t1", "b21", "title", "0.2"),
    ("t1", "b22", "tags", "0.6"),
    ("t2", "a", "title", "0.35"),
    ("t2", "a", "price.sale", "0.15"),
    ("t2", "b", "brand", "0.45"),
]
values(
    "mod_item_dimension",
    "id STRING; parent_id STRING; parent_ids STRING; weight DECIMAL(6,3); category STRING",
    per_category(_TREE, lambda c, n: (_inside(c, n[0]), _inside(c, n[1]), n[2], n[3], c)),
)
values(
    "int_item_dimension_measure",
    "dimension_id STRING; measure_id STRING; weight DECIMAL(6,3); category STRING",
    per_category(_TREE_MAP, lambda c, n: (_inside(c, n[0]), f"{c}-m-{n[1]}", n[2], c)),
)
values(
    "mod_measure",
    "id STRING; property STRING; category STRING",
    [(f"{c}-m-{p}", p, c) for c, *_ in _CATEGORIES for p, _ in ITEM_PAIRS if p not in ("props.0.k", "tagging")],
)
ITEM_SCRIPT = "CASE WHEN p['price.sale'].score > 0.5 THEN concat('high ', p['brand'].value) ELSE 'low' END"
ITEM_STYLE = "concat(p['title'].value, '/', p['props.0.v'].value)"
_EVAL_NODES = [
    ("t1", "perf", "0", "0,", "1", "perform", None),
    ("t1", "ea", "perf", "0,perf,", "0.4", "a", None),
    ("t1", "eb", "perf", "0,perf,", "0.35", "B", None),
    ("t1", "ec", "perf", "0,perf,", "0.25", "c", None),
    ("t1", "cost", "0", "0,", "1", "cost", None),
    ("t1", "ex", "cost", "0,cost,", "0.6", "x", None),
    ("t1", "ey", "cost", "0,cost,", "0.4", "y", None),
    ("t1", "con", "0", "0,", "1", "constraint", ITEM_SCRIPT),
    ("t1", "sat", "0", "0,", "1", "satisify", None),
    ("t1", "sat2", "0", "0", "1", "satisfy", None),
    ("t1", "ctx", "0", "0,", "1", "context", None),
    ("t1", "ign", "0", "0,", "1", "ignore", None),
    ("t1", "sty", "0", "0,", "1", "style", ITEM_STYLE),
    ("t2", "perf", "0", "0,", "1", "perform", None),
    ("t2", "ea", "perf", "0,perf,", "1", "a", None),
    ("t2", "con", "0", "0,", "1", "constraint", ITEM_SCRIPT),
    ("t2", "sat", "0", "0,", "1", "satisify", None),
    ("t2", "ctx", "0", "0,", "1", "context", None),
    ("t2", "dnc", "0", "0,", "1", "do-not-care", None),
]
_EVAL_MAP = [
    ("t1", "ea", "a", "0.5"),
    ("t1", "ea", "b", "0.5"),
    ("t1", "eb", "r", "0.8"),
    ("t1", "ec", "c", "1"),
    ("t1", "ex", "a1", "0.9"),
    ("t1", "ey", "b2", "0.7"),
    ("t1", "con", "r", "1"),
    ("t2", "ea", "r", "0.65"),
]
values(
    "mod_item_evaluation",
    "id STRING; parent_id STRING; parent_ids STRING; weight DECIMAL(6,3); type STRING; script STRING; category STRING",
    per_category(_EVAL_NODES, lambda c, n: (_inside(c, n[0]), _inside(c, n[1]), *n[2:], c)),
)
values(
    "int_item_evaluation_dimension",
    "evaluation_id STRING; dimension_id STRING; weight DECIMAL(6,3); category STRING",
    per_category(_EVAL_MAP, lambda c, n: (_inside(c, n[0]), _inside(c, n[1]), n[2], c)),
)
values(
    "mod_motivation",
    "id STRING; name STRING",
    [("m1", "save"), ("m2", "learn"), ("m3", "play"), ("m4", "rest"), ("m5", "share")],
)
values(
    "mod_occasion",
    "id STRING; name STRING",
    [("o1", "birthday"), ("o2", "holiday"), ("o3", "travel"), ("o4", "school"), ("o5", "winter")],
)

# --- user configuration ----------------------------------------------------------------------------------

values(
    "mod_user_dimension",
    "id STRING; parent_id STRING; parent_ids STRING; weight DECIMAL(6,3)",
    [
        ("r", "0", "0,", "1"),
        ("wealth", "r", "0,r,", "0.6"),
        ("place", "r", "0,r", "0.4"),
        ("cash", "wealth", "0,r,wealth,", "0.7"),
        ("work", "wealth", "0,r,wealth", "0.3"),
        ("home", "place", "0,r,place", "0.5"),
        ("trip", "place", "0,r,place,", "0.5"),
        ("alone", "0", "0,", "1"),
    ],
)
values(
    "int_user_dimension_measure",
    "dimension_id STRING; measure_id STRING; weight DECIMAL(6,3)",
    [
        ("cash", "um-account.balance", "0.8"),
        ("work", "um-segment", "0.5"),
        ("place", "um-nation", "0.9"),
        ("home", "um-nation", "0.4"),
        ("home", "um-segment", "0.1"),
        ("alone", "um-segment", "0.25"),
    ],
)
values(
    "mod_user_measure",
    "id STRING; property STRING",
    [("um-segment", "segment"), ("um-account.balance", "account.balance"), ("um-nation", "nation")],
)
USER_SCRIPT = "CASE WHEN p['segment'].value = 'BUILDING' THEN 'builder' ELSE lower(p['segment'].value) END"
USER_NULL_SCRIPT = "CASE WHEN p['nation'].value = '3' THEN p['name'].value END"
_USER_EVALS = [
    (1, "cap", "0", "0,", "1", "capability", None, None),
    (2, "eco", "cap", "0,cap,", "0.5", "economy", None, "must"),
    (3, "soc", "cap", "0,cap,", "0.3", "society", None, "should"),
    (4, "cul", "cap", "0,cap,", "0.2", "culture", None, "filter"),
    (5, "dem", "0", "0,", "1", "demands", None, "must"),
    (6, "occ", "0", "0,", "1", "occasion", None, "should"),
    (7, "per", "0", "0,", "1", "persona", None, "must_not"),
    (8, "sty", "0", "0,", "1", "style", None, "should"),
    (9, "hie", "0", "0,", "1", "hierarchy", None, "other"),
    (10, "bt", "0", "0,", "1", "brand::tags", USER_SCRIPT, "Must"),
    (11, "con", "0", "0,", "1", "constraint", USER_NULL_SCRIPT, "filter"),
]
values(
    "user_eval_nodes",
    "i INT; id STRING; parent_id STRING; parent_ids STRING; weight DECIMAL(6,3); type STRING; script STRING; category STRING",
    _USER_EVALS,
)
view(
    "mod_user_evaluation",
    "user_eval_nodes",
    "SELECT id, parent_id, parent_ids, weight, type, script, category FROM user_eval_nodes",
)
values(
    "int_user_evaluation_dimension",
    "evaluation_id STRING; dimension_id STRING; weight DECIMAL(6,3)",
    [("eco", "wealth", "0.75"), ("eco", "cash", "0.25"), ("soc", "r", "0.6"), ("soc", "alone", "0.4"), ("cul", "trip", "1")],
)
HIERARCHY = [
    ("h1", "try_cast(p['account.balance'].value AS DOUBLE) > 5000"),
    ("h2", "p['segment'].score * 2"),
    ("h3", "p['name'].value"),
]
PHASE = [
    ("ph1", "p['nation'].rank + 1"),
    ("ph2", "p['segment'].value = 'BUILDING'"),
    ("ph3", "p['economy'].score"),
]
PERSONA = [
    ("per1", "h1", "ph1", "p['nation'].rank", "0.1", "0.2", "0.3", "0.4", "0.75"),
    ("per2", "h2", "ph2", "p['economy'].var", "0.25", "x", "0.35", None, "0.6"),
    ("per3", "h3", "ph3", "p['nation'].value", "1", "0.9", "0.8", "0.7", "0.65"),
    ("per4", "h1", "ph2", "p['brand::tags'].text = 't1'", "0.5", "0.5", "0.5", "0.5", "0.5"),
    ("per5", "h2", "ph3", "p['none'].score", "0.15", "0.85", "none", "0.55", ""),
    ("per6", "h3", "ph1", "p['segment'].rank + p['account.balance'].rank", "0.45", "0.3", "0.2", "0.1", "0.05"),
]
values("mod_hierarchy", "id STRING; expression STRING", HIERARCHY)
values("mod_phase", "id STRING; expression STRING", PHASE)
values(
    "mod_persona",
    "id STRING; hierarchy_id STRING; phase_id STRING; expression STRING; alpha STRING; beta STRING; gamma STRING; "
    "delte STRING; epsilon STRING",
    PERSONA,
)
values(
    "persona_ids",
    "i INT; hierarchyId STRING; phaseId STRING; personaId STRING",
    [(n + 1, h, ph, p) for n, (p, h, ph, *_) in enumerate(PERSONA)],
)
values(
    "mod_life_style",
    "persona_id STRING; motivation_ids STRING; occasion_ids STRING",
    [
        ("per1", "m1,m3", "o1"),
        ("per2", "m2", "o2, o5"),
        ("per3", "", "o3"),
        ("per4", "m5,m4,m3", None),
        ("per5", "m9", "o4,o1"),
        ("per6", None, "o5"),
    ],
)

# --- facts -----------------------------------------------------------------------------------------------

view(
    "item_property",
    "item_flat category_tree mod_measure",
    f"""SELECT f.property, f.value, f.category, f.itemKey, c.id AS categoryId, m.id AS propertyId,
       CASE WHEN mod(f.rank, 2) = 0 THEN CAST(f.rank * CAST(0.083 AS DECIMAL(4,3)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN mod(f.rank, 2) = 0 THEN f.rank END AS rank,
       CASE WHEN mod(f.rank, 2) = 0 THEN 'ready' ELSE 'pending' END AS status, 1 AS revision
    FROM (SELECT *, {RANK} AS rank FROM item_flat) f
    LEFT JOIN category_tree c ON c.name = f.category
    LEFT JOIN mod_measure m ON m.category = c.id AND m.property = f.property""",
)
view(
    "user_property",
    "user_flat mod_user_measure",
    f"""SELECT f.property, f.value, f.userKey, m.id AS propertyId,
       CASE WHEN mod(f.rank, 2) = 0 THEN CAST(f.rank * CAST(0.083 AS DECIMAL(4,3)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN mod(f.rank, 2) = 0 THEN f.rank END AS rank,
       CASE WHEN mod(f.rank, 2) = 0 THEN 'ready' ELSE 'pending' END AS status, 1 AS revision
    FROM (SELECT *, {RANK} AS rank FROM user_flat) f
    LEFT JOIN mod_user_measure m ON m.property = f.property""",
)
view(
    "item_measure",
    "part category_tree mod_item_dimension int_item_dimension_measure",
    """SELECT CAST(p.p_partkey AS STRING) AS itemKey, d.parent_id AS parent, d.id AS dimension, d.weight,
       CASE WHEN l.dimension IS NOT NULL AND mod(p.p_partkey + length(d.id), 5) <> 0
            THEN CAST(mod(p.p_partkey * 7 + length(d.parent_ids) + ascii(substr(d.id, 4, 1)), 97)
                 * CAST(0.007 AS DECIMAL(4,3)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN mod(p.p_partkey, 3) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CAST(CASE WHEN l.dimension IS NOT NULL THEN 900 ELSE 400 + mod(length(d.parent_ids), 5) END AS INT) AS priority,
       1 AS revision
    FROM part p JOIN category_tree c ON c.name = p.p_type
    JOIN mod_item_dimension d ON d.category = c.id
    LEFT JOIN (SELECT DISTINCT dimension_id AS dimension FROM int_item_dimension_measure) l
      ON l.dimension = d.id""",
)
view("customer_8", "customer", numbered("customer", 8))
values(
    "user_dims",
    "i INT; dimension STRING; parent STRING; weight DECIMAL(6,3); leaf INT",
    [
        (1, "r", "0", "1", 0),
        (2, "wealth", "r", "0.6", 0),
        (3, "place", "r", "0.4", 1),
        (4, "cash", "wealth", "0.7", 1),
        (5, "work", "wealth", "0.3", 1),
        (6, "home", "place", "0.5", 1),
        (7, "trip", "place", "0.5", 0),
        (8, "alone", "0", "1", 1),
    ],
)
view(
    "user_measure",
    "customer_8 user_dims",
    """SELECT CAST(c.c_custkey AS STRING) AS userKey, d.parent, d.dimension, d.weight,
       CASE WHEN d.leaf = 1 AND mod(c.c_custkey + d.i, 7) <> 0
            THEN CAST(mod(c.c_custkey * 11 + d.i * 5, 89) * CAST(0.011 AS DECIMAL(4,3)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN mod(c.c_custkey, 3) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CAST(CASE WHEN d.leaf = 1 THEN 900 ELSE 400 + d.i END AS INT) AS priority, 1 AS revision
    FROM customer_8 c JOIN user_dims d ON c.i = d.i""",
)
view("idle_measure", "user_measure", "SELECT userKey, parent, dimension, weight, score, 'ready' AS status, priority, revision FROM user_measure")
view(
    "item_evaluation",
    "part category_tree mod_item_evaluation",
    """SELECT CAST(p.p_partkey AS STRING) AS itemKey, e.parent_id AS parent, e.id AS evaluation, e.weight, e.type, e.script,
       e.category, mod(p.p_partkey, 4) <> 0 AS featured,
       CASE WHEN e.type IN ('a', 'B', 'x', 'y') AND mod(p.p_partkey, 6) <> 0
            THEN CAST(mod(p.p_partkey * 3 + ascii(e.type), 53) * CAST(0.013 AS DECIMAL(4,3)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN e.type IN ('style', 'context') THEN e.type || '-' || CAST(mod(p.p_partkey, 10) AS STRING) END AS text,
       CASE WHEN mod(p.p_partkey, 5) < 3 THEN 'ready' ELSE 'pending' END AS status,
       CAST(500 + length(e.type) AS INT) AS priority, 1 AS revision
    FROM part p JOIN category_tree c ON c.name = p.p_type JOIN mod_item_evaluation e ON e.category = c.id""",
)
view("customer_11", "customer", numbered("customer", 11))
view(
    "user_evaluation",
    "customer_11 user_eval_nodes",
    """SELECT CAST(c.c_custkey AS STRING) AS userKey, e.parent_id AS parent, e.id AS evaluation, e.weight, e.type, e.script,
       e.category, 'per' || CAST(1 + mod(c.c_custkey, 6) AS STRING) AS persona, mod(c.c_custkey + e.i, 3) <> 0 AS featured,
       CASE WHEN e.type IN ('economy', 'society', 'culture') AND mod(c.c_custkey, 9) <> 0
            THEN CAST(mod(c.c_custkey * 7 + e.i, 100) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,6)) END AS score,
       CASE WHEN e.type IN ('brand::tags', 'demands') THEN 't' || CAST(mod(c.c_custkey, 4) AS STRING)
            WHEN e.type = 'occasion' THEN ' ' END AS text,
       CASE WHEN mod(c.c_custkey, 4) < 3 THEN 'ready' ELSE 'pending' END AS status,
       CAST(500 + e.i AS INT) AS priority, 1 AS revision
    FROM customer_11 c JOIN user_eval_nodes e ON c.i = e.i""",
)
view(
    "user_query",
    "customer_11 user_eval_nodes",
    """SELECT CAST(c.c_custkey AS STRING) AS userKey, e.category, 'match' AS type,
       CASE WHEN e.type = 'brand::tags' THEN 'brand' ELSE '-' END AS subType,
       CASE WHEN e.type = 'brand::tags' THEN 'tags' ELSE e.type END AS field,
       CASE mod(c.c_custkey + e.i, 4) WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'text-' || CAST(e.i AS STRING) END AS text,
       'pending' AS status, 1 AS revision
    FROM customer_11 c JOIN user_eval_nodes e ON c.i = e.i""",
)
view("customer_6", "customer", numbered("customer", 6))
view(
    "user_persona",
    "customer_6 persona_ids",
    """SELECT CAST(c.c_custkey AS STRING) AS userKey, p.hierarchyId, p.phaseId, p.personaId,
       CASE WHEN mod(c.c_custkey, 11) <> 0 OR p.i > 2 THEN CAST(mod(c.c_custkey + p.i, 3) AS DOUBLE) END AS scoreHierarchy,
       CAST(mod(c.c_nationkey + p.i, 2) AS DOUBLE) AS scorePhase,
       CASE WHEN mod(c.c_custkey * p.i, 7) <> 0 THEN CAST(mod(c.c_custkey * p.i, 5) AS DOUBLE) / 4 END AS scorePersona,
       CASE WHEN mod(c.c_custkey, 3) = 0 THEN 'pending' ELSE 'ready' END AS status, 1 AS revision
    FROM customer_6 c JOIN persona_ids p ON c.i = p.i""",
)
view(
    "user_filter",
    "customer",
    """SELECT CAST(c_custkey AS STRING) AS userKey,
       CASE WHEN mod(c_custkey, 5) = 0 THEN 'pending' ELSE 'ready' END AS status,
       CAST(1 + mod(c_custkey, 3) AS INT) AS revision
    FROM customer""",
)
