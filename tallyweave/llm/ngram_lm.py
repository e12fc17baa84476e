"""Language-model scoring by cross-entropy difference.

Two n-gram models of the same order share one vocabulary, the 256 bytes.  The background
model counts the n-grams of all documents, the target model those of the target texts (of the
same table or any other).  A document's score is the mean over its bytes of the target model's loss less
the background model's loss: below 0 for texts that look more like the target.

Every n-gram of every text is counted, whatever the corpus, and none is pruned: the counted
table grows with the input.  Counts are summed per chunk of texts before they are shuffled,
so a frequent n-gram is a handful of rows.  Lower orders are marginals of the same counts.
The probability of a byte is interpolated with the next lower order,

    p_n(w | c) = (m * count(c w) + STRENGTH * p_(n-1)(w | c')) / (m * count(c) + STRENGTH),

down to the uniform distribution over the vocabulary.  The models are matched: m weighs the
counts of the larger corpus, so that both weigh as many bytes against the prior and the difference tells
the texts apart, not the sizes of what was counted.  The table of losses is sent to every task
while it has at most ``broadcast_rows`` rows (20 bytes each); a larger one is joined with the
documents' own n-gram counts by a shuffle; both sum the same losses in double precision.

Nulls are empty texts, and empty texts have no bytes and score 0.  Without target texts the target
model is the uniform prior; the scores are still defined.  Repeated rows count each time and get
equal scores; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, modest_batches, restored
from tallyweave.llm.words import chunks, texts
from tallyweave.session import shared_folder

ORDER = 4
STRENGTH = 4.0
BROADCAST_ROWS = 1 << 23


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram ending at each byte, as a number; texts begin after zero bytes."""
    at = np.arange(len(data), dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.astype(np.uint32)
    for back in range(1, order):
        before = np.zeros(len(data), np.uint32)
        before[back:] = data[: len(data) - back]
        before[at < back] = 0
        out |= before << np.uint32(8 * back)
    return out


def count_grams(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(gram, n): how often each n-gram ends in the texts, summed per task and chunk but not over all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                found = grams(data[offsets[first] : offsets[last]], own, order)
                pending.append(np.unique(found, return_counts=True))
                held += len(pending[-1][0])
                if held > 1 << 21:
                    pending = [_summed(pending)]
                    if len(pending[0][0]) > 1 << 20:
                        yield _batch(pending.pop())
                    held = sum(len(k) for k, _ in pending)
        if pending:
            yield _batch(_summed(pending))

    return docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(work, "gram long, n long")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _batch(part: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part[0].astype(np.int64)), pa.array(part[1].astype(np.int64))], names=["gram", "n"]
    )


def both_counts(docs: DataFrame, target: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(gram, background, target) of every n-gram of either corpus."""
    zero = F.lit(0).cast("long")
    background = count_grams(docs, text_col, order).select("gram", F.col("n").alias("background"), zero.alias("target"))
    aimed = count_grams(target, text_col, order).select("gram", zero.alias("background"), F.col("n").alias("target"))
    return background.union(aimed).groupBy("gram").agg(
        F.sum("background").alias("background"), F.sum("target").alias("target")
    )


def losses(counted: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """(gram, target_loss, background_loss) in nats, of every counted n-gram.

    Each lower order is the sum over the first byte; all orders meet in joins on the
    n-gram's ending, which spread over as many keys as there are endings.
    """
    kinds = ("target", "background")
    sums = counted.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in kinds]).first()
    # without one of the corpora there is nothing to match
    weight = {k: min(sums) / sums[k] if min(sums) else 1.0 for k in kinds}
    current = counted.select("gram", *kinds)
    levels = [current]
    for n in range(order - 1, 0, -1):
        shorter = (
            levels[-1]
            .groupBy((F.col("gram") % F.lit(1 << (8 * n))).alias("gram"))
            .agg(*[F.sum(k).alias(k) for k in kinds])
        )
        levels.append(shorter)
    known = None
    for n in range(1, order + 1):
        level = levels[order - n]
        context = level.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(
            *[F.sum(k).alias(f"{k}_total") for k in kinds]
        )
        rows = level.withColumn("context", F.shiftrightunsigned("gram", 8)).join(context, "context")
        if known is None:
            lower = {k: F.lit(1.0 / 256) for k in kinds}
        else:
            rows = rows.withColumn("ending", F.col("gram") % F.lit(1 << (8 * (n - 1)))).join(
                known.select(F.col("gram").alias("ending"), *[F.col(f"{k}_p").alias(f"{k}_q") for k in kinds]), "ending"
            )
            lower = {k: F.col(f"{k}_q") for k in kinds}
        known = rows.select(
            "gram",
            *[
                ((weight[k] * F.col(k) + strength * lower[k]) / (weight[k] * F.col(f"{k}_total") + strength)).alias(f"{k}_p")
                for k in kinds
            ],
        )
    return known.select("gram", *[(-F.log(F.col(f"{k}_p"))).alias(f"{k}_loss") for k in kinds])


def score_documents(
    docs: DataFrame,
    target: DataFrame,
    text_col: str = "text",
    order: int = ORDER,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``docs`` against the texts of ``target``: n_tokens (long), target_loss, background_loss and score (mean nats per byte).

    Columns of those names are replaced.  The table of losses is written to the shared folder
    once; its row count decides between broadcast and shuffle join.
    """
    if not 1 <= order <= 4:
        raise ValueError("n-grams of one to four bytes")
    spark = docs.sparkSession
    modest_batches(spark)
    path = shared_folder(spark, "ngram-losses")
    counts = f"{path}/counts"
    both_counts(docs, target, text_col, order).write.parquet(counts)
    losses(spark.read.parquet(counts), order).write.parquet(f"{path}/losses")
    table = spark.read.parquet(f"{path}/losses")
    if table.count() <= broadcast_rows:
        return _score_local(docs, table, text_col, order)
    return _score_joined(docs, table, text_col, order)


NAMES = ("n_tokens", "target_loss", "background_loss", "score")


def _score_local(docs: DataFrame, table: DataFrame, text_col: str, order: int) -> DataFrame:
    found = table.toArrow()
    keys = found.column("gram").to_numpy().astype(np.uint32)
    sort = np.argsort(keys)
    values = [found.column(f"{k}_loss").to_numpy()[sort] for k in ("target", "background")]
    shared = docs.sparkSession.sparkContext.broadcast((keys[sort], *values))
    source, inner, kept = carried(docs, text_col, NAMES)
    schema = source.select(*inner).schema.add("n_tokens", "long")
    for name in NAMES[1:]:
        schema = schema.add(name, "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, target_loss, background_loss = shared.value
        for batch in batches:
            data, offsets = texts(batch.columns[-1])
            sums = np.zeros((2, len(offsets) - 1))
            for first, last in chunks(offsets, 1 << 20):
                own = offsets[first : last + 1] - offsets[first]
                at = np.searchsorted(known, grams(data[offsets[first] : offsets[last]], own, order))
                some = own[1:] > own[:-1]
                if not some.any():
                    continue
                for k, loss in enumerate((target_loss, background_loss)):
                    sums[k, first:last][some] = np.add.reduceat(loss[at], own[:-1][some])
            n = np.diff(offsets)
            means = sums / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(n.astype(np.int64)),
                    pa.array(means[0]),
                    pa.array(means[1]),
                    pa.array(means[0] - means[1]),
                ],
                names=[*inner, *NAMES],
            )

    return source.mapInArrow(work, schema).select(*restored(inner, kept), *NAMES)


def _score_joined(docs: DataFrame, table: DataFrame, text_col: str, order: int) -> DataFrame:
    """By a shuffle: each text's distinct n-grams meet the table, the sums come back by content."""
    own = docs.select(F.col(f"`{text_col}`").alias("text")).where(F.octet_length("text") > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py().encode()
                data = np.frombuffer(text, np.uint8)
                keys, counts = np.unique(grams(data, np.array([0, len(data)]), order), return_counts=True)
                name = hashlib.sha256(text).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["blob", "gram", "n"],
                )

    # equal texts share a content name: one of them is enough
    distinct = own.dropDuplicates(["text"])
    items = distinct.mapInArrow(work, "blob string, gram long, n long")
    sums = (
        items.join(table, "gram")
        .groupBy("blob")
        .agg(
            F.sum("n").alias("n_tokens"),
            F.sum(F.col("n") * F.col("target_loss")).alias("t"),
            F.sum(F.col("n") * F.col("background_loss")).alias("b"),
        )
    )
    source, inner, kept = carried(docs, text_col, NAMES)
    keyed = source.select(*inner, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("blob"))
    joined = keyed.join(sums.select("blob", *[F.col(c).alias(f"__{c}") for c in ("n_tokens", "t", "b")]), "blob", "left")
    n = F.coalesce(F.col("__n_tokens"), F.lit(0))
    mean = {c: F.coalesce(F.col(f"__{c}") / F.col("__n_tokens"), F.lit(0.0)) for c in ("t", "b")}
    return joined.select(
        *restored(inner, kept),
        n.alias("n_tokens"),
        mean["t"].alias("target_loss"),
        mean["b"].alias("background_loss"),
        (mean["t"] - mean["b"]).alias("score"),
    )
