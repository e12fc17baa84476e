"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every document is a blob, named by the SHA-256 of its text.  The ledger
has one row for each blob and rule version that was scanned, with what was found.  A run
scans only the pairs the ledger lacks, each distinct blob once however many paths hold it,
and joins the findings back to all paths.  A new rule version makes every blob unseen again.

Only DataFrame functions are used.  A match's place is the running length of the pieces
between matches: the same pattern splits the text and extracts the matches, so the two
lists interleave to the text; lengths count code points.

Null texts are empty texts, empty texts have no findings, repeated rows and equal texts of
several documents share a blob and each keep a row of their own; an empty table gives an
empty report.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored


class Rule(NamedTuple):
    """A kind of secret: its pattern, the group whose length counts, and the least length."""

    kind: str
    pattern: str
    group: int
    least: int
    #: texts without it cannot match; "" where there is no such literal
    literal: str = ""


# The base kinds, in the order in which ties are listed.
# A run of hexadecimal digits or of AKIA letters is matched whole, so its least length is part of the pattern.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)

# What this scan adds: key blocks and tokens with a published prefix.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, "eyJ"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, "_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "xox"),
)

RULES = BASE + ADDED
RULE_VERSION = "1"

_SPAN = "struct<start:int,ord:int,kind:string,end:int>"


def blob_id(text: Column) -> Column:
    """The name of a text's content."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen_blobs(
    docs: DataFrame, ledger: DataFrame | None, text_col: str = "text", version: str = RULE_VERSION
) -> DataFrame:
    """(blob, text), one row for each content that ``version`` has not scanned yet."""
    blobs = docs.select(
        blob_id(F.col(f"`{text_col}`")).alias("blob"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    # one row a blob before they meet the ledger, so that copies of a text do not gather in one task
    blobs = blobs.dropDuplicates(["blob"])
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    return blobs


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION) -> DataFrame:
    """Ledger rows (blob, rule_version, spans) of every blob; spans are sorted by start, then kind."""
    found = []
    for order, rule in enumerate(rules):
        pattern = F.lit(rule.pattern)
        parts = F.struct(
            F.lit(order).alias("ord"),
            F.lit(rule.kind).alias("kind"),
            F.split(F.col("text"), rule.pattern, -1).alias("gaps"),
            F.regexp_extract_all("text", pattern, F.lit(0)).alias("hits"),
            F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("groups"),
            F.lit(rule.least).alias("least"),
        )
        likely = F.contains(F.col("text"), F.lit(rule.literal)) if rule.literal else F.lit(True)
        found.append(F.when(likely & F.rlike("text", pattern), parts))
    kinds = blobs.select("blob", F.array_compact(F.array(*found)).alias("found"))
    each = kinds.select("blob", F.explode_outer("found").alias("f"))
    hits = each.select(
        "blob", "f.ord", "f.kind", "f.least", F.posexplode_outer(F.arrays_zip("f.gaps", "f.hits", "f.groups"))
    )
    before = Window.partitionBy("blob", "ord").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("col.hits")
    end = F.sum(F.length("col.gaps") + F.coalesce(size, F.lit(0))).over(before).cast("int")
    spans = hits.withColumn("end", end).select(
        "blob",
        F.when(
            F.length("col.groups") >= F.col("least"),
            F.struct((F.col("end") - size).alias("start"), "ord", "kind", "end"),
        ).alias("span"),
    )
    return spans.groupBy("blob").agg(
        F.lit(version).alias("rule_version"), F.array_sort(F.collect_list("span")).cast(f"array<{_SPAN}>").alias("spans")
    )


def extend_ledger(
    docs: DataFrame, path: str, ledger: DataFrame | None = None, text_col: str = "text", version: str = RULE_VERSION
) -> DataFrame:
    """Scan what ``ledger`` lacks, append it to the ledger's folder and return the whole ledger.

    ``path`` is a folder all executors share; a run that was cut short has appended nothing, as
    Spark commits its files together.
    """
    scan_blobs(unseen_blobs(docs, ledger, text_col, version), version=version).write.mode("append").parquet(path)
    return docs.sparkSession.read.parquet(path)


def findings(docs: DataFrame, ledger: DataFrame, text_col: str = "text", version: str = RULE_VERSION) -> DataFrame:
    """``docs`` with ``spans``, the findings of the blob each row holds; other columns stay as they are.

    Blobs without findings are left out of the join, so what meets the documents is a
    fraction of them; the join drops no row.
    """
    found = ledger.where((F.col("rule_version") == version) & (F.size("spans") > 0)).select(
        "blob", F.col("spans").alias("found")
    )
    source, inner, kept = carried(docs, text_col, ["spans"])
    joined = source.select(*inner, blob_id(F.col("text")).alias("blob")).join(found, "blob", "left")
    return joined.select(
        *restored(inner, kept), F.coalesce("found", F.array().cast(f"array<{_SPAN}>")).alias("spans")
    )


def spelled(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every stretch of its spans replaced by one mark; overlapping spans are one stretch."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        apart = (span["start"] > state["at"]) | (F.size(state["parts"]) == 0)
        gap = F.array(F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["parts"], gap)).otherwise(state["parts"]).alias("parts"),
        )

    def close(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, close))
