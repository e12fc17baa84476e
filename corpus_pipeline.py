"""A filtering pipeline over ``documents``: each stage is written and read again by the next.

Quality rules drop what they reject; of each group of near duplicates one document stays;
documents that hold a window of a benchmark item go; secrets are cut out of the texts; the
last stage adds token ids.  All stages but the last return the columns of their input.

Null texts are empty ones: the quality rules reject them, and where a later stage is given some
they stay.  Equal rows are judged alike; only near_dedup makes one of them.  Columns other
than doc_id, text and n_chars are carried whatever their names.  Empty tables come out
empty, and a benchmark or labels without rows reject nothing by what they would have said.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import line_crf, secrets
from tallyweave.llm.bpe import encode_documents
from tallyweave.llm.columns import carried, restored
from tallyweave.llm.decontaminate import decontaminate
from tallyweave.llm.near_dups import near_duplicates
from tallyweave.llm.queries import labels, vocabulary
from tallyweave.session import remove_folder, shared_folder, steps_removed

# Near duplicates share this percentage of their runs of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base rules hold and whose words stand mostly in content lines."""
    model = line_crf.train(docs, labels(spark, sf_dir).withColumnRenamed("quality", "label"))
    source, inner, kept = carried(docs, "text", [])
    return line_crf.judge(source, model).where("kept").select(*restored(inner, kept))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near duplicates: that of the least doc_id, a row without an id last.

    A row is its doc_id and text, null included: rows equal in both are one, rows that share a
    doc_id and differ in text are compared like any others.  A group is what links of
    ``NEAR_PERCENT`` by runs of ``NEAR_WORDS`` words connect.
    """
    source, inner, kept = carried(docs, "text", [])
    doc_id = F.col(inner[kept.index("doc_id")])
    # a row's name sorts like what shall stay
    name = F.struct(F.isnull(doc_id).alias("none"), doc_id.alias("id"), F.md5(F.col("text").cast("binary")).alias("md5"))
    named = source.withColumn("name", name)
    found = near_duplicates(named, "name", percent=NEAR_PERCENT, width=NEAR_WORDS)
    gone = found.where("NOT kept").select("name").distinct()
    left = named.join(gone, named["name"].eqNullSafe(gone["name"]), "left_anti")
    return left.dropDuplicates(["name"]).select(*restored(inner, kept))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    source, inner, kept = carried(docs, "text", [])
    return decontaminate(source, benchmark).where("n_hit = 0").select(*restored(inner, kept))


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and its length set anew."""
    source, inner, kept = carried(docs, "text", [])
    found = secrets.findings(source, secrets.extend_ledger(source, shared_folder(spark, "secret-ledger")))
    cut = found.withColumn("text", secrets.redact(F.col("text"), F.col("spans")))
    # a text without secrets keeps what its row says, null included
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(
        *[
            (F.when(F.size("spans") > 0, new[c]).otherwise(F.col(i)) if c in new else F.col(i)).alias(c)
            for c, i in zip(kept, inner)
        ]
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the digests of ids and decoded text.

    Columns named ids, n_tokens, ids_sha256 or decoded_sha256 are replaced.
    """
    names = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    return encode_documents(docs, vocabulary(), **{n: n for n in names})


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", drop_contaminated),
    ("secrets", cut_secrets),
    ("bpe", encode),
]

# A model, exact set similarity and byte-pair merges are beyond SQL: tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; what each returns is a table of its own, so no stage is computed twice.

    Once a stage is written, what it was made from is removed: the steps it wrote on the way
    and the table of the stage before.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        with steps_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
        docs = spark.read.parquet(path)
    return docs
