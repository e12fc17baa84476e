"""Bounded samples of labelled texts for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    texts: int,
    text_bytes: int,
    key: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
) -> dict[int, list[str]]:
    """Up to ``texts`` distinct texts of each label 0 and 1, those of least hash, none over ``text_bytes``.

    The choice is made on keys, sizes and hashes; only the chosen texts are gathered, so the
    driver holds 2 * ``texts`` * ``text_bytes`` bytes at most.  Copies of a text count once.
    """
    facts = docs.select(
        F.col(f"`{key}`").alias("key"), F.octet_length(text_col).alias("size"), F.xxhash64(text_col).alias("h")
    ).where((F.col("size") > 0) & (F.col("size") <= text_bytes))
    marked = labels.select(F.col(f"`{key}`").alias("key"), F.col(label_col).cast("int").alias("label"))
    # one row per text and label: copies of a text do not meet in one task
    known = facts.join(marked.where(F.col("label").isin(0, 1)), "key").groupBy("h", "label").agg(F.max("size").alias("size"))
    chosen: dict[int, int] = {}
    for label in (0, 1):
        for row in known.where(F.col("label") == label).orderBy("h").limit(texts).collect():
            chosen.setdefault(row["h"], label)
    out: dict[int, list[str]] = {0: [], 1: []}
    if chosen:
        found = (
            docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
            .where(F.col("h").isin(list(chosen)))
            .dropDuplicates(["h"])
        )
        for row in sorted(found.collect(), key=lambda r: r["h"]):
            out[chosen[row["h"]]].append(row["text"])
    return out
