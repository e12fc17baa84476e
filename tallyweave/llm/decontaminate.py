"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words (a shorter item is one window).  A window
is a set of shingles, each a run of ``SHINGLE`` of its words with its place.  A text contains
a window only if it contains all its shingles, so one of them is prefix enough: the rarest.

1. The shingles of the benchmark are counted in all documents.
2. Each window keeps its rarest shingle (ties: the first) as its prefix token.
3. Documents post their occurrences of prefix tokens, which meet the windows in a join on
   the token.  A window placed by its token must lie inside the document (position and
   length bounds); then its words are compared one by one with the words around the token.
4. Verified occurrences are gathered per document into hit words and items.

A bit table of fixed size (``FILTER_BITS``), built from the benchmark's tokens, spares most
words of the corpus any further look; its false alarms are undone by the join.  Tokens are
64-bit hashes and only propose; the words themselves decide.

Words are lower-cased in A-Z.  Null texts and items have no words and never hit.  Items of
equal text each count, an id that several items share once.  An item without an id hits like any
other but stands in no list of items.  Repeated rows give a row each; rows are told apart by content, so
two rows of equal text get equal results.  An empty benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, modest_batches, restored
from tallyweave.llm.words import NOT_ALNUM, U64, Words, as_long, chunks, texts, window_hash
from tallyweave.session import shared_folder

WINDOW = 10
SHINGLE = 3
FILTER_BITS = 24

_WINDOW_FIELDS = "item_id string, words array<string>, n int, shingles array<struct<token:long,place:int>>"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        data, offsets = texts(batch.column(1))
        for first, last in chunks(offsets):
            own = offsets[first : last + 1] - offsets[first]
            words = Words(data[offsets[first] : offsets[last]], own, NOT_ALNUM, fold=True)
            raw = words.data.tobytes()
            spelled = [raw[s:e].decode() for s, e in zip(words.start.tolist(), words.end.tolist())]
            hashes = words.hashes()
            tokens = {k: window_hash(hashes, k).view(np.int64).tolist() for k in range(1, SHINGLE + 1)}
            for r in range(last - first):
                lo, hi = int(words.first[r]), int(words.first[r + 1])
                size = min(WINDOW, hi - lo)
                wide = min(SHINGLE, size)
                for at in range(lo, hi - size + 1) if size else ():
                    places = range(at, at + size - wide + 1)
                    rows.append(
                        (
                            ids[first + r],
                            spelled[at : at + size],
                            size,
                            [{"token": tokens[wide][p], "place": p - at} for p in places],
                        )
                    )
        for at in range(0, len(rows), 5000):
            part = rows[at : at + 5000]
            shingle = pa.struct([("token", pa.int64()), ("place", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], pa.string()),
                    pa.array([r[1] for r in part], pa.list_(pa.string())),
                    pa.array([r[2] for r in part], pa.int32()),
                    pa.array([r[3] for r in part], pa.list_(shingle)),
                ],
                names=["item_id", "words", "n", "shingles"],
            )


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, items, words, n, shingles): the distinct windows of a benchmark and who holds them."""
    source = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = source.mapInArrow(_item_windows, _WINDOW_FIELDS)
    return rows.groupBy("words", "n", "shingles").agg(F.collect_set("item_id").alias("items"))


def bit_table(tokens: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Which of 2^bits cells hold a token; 2^bits / 8 bytes reach the driver at most."""
    cell = F.shiftrightunsigned("token", 64 - bits)
    words = (
        tokens.select(cell.alias("cell"))
        .groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros((1 << bits) // 64 or 1, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(U64)


def in_table(table: np.ndarray, keys: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    cell = keys >> U64(64 - bits)
    return (table[cell >> U64(6)] >> (cell & U64(63))) & U64(1) == 1


def token_counts(docs: DataFrame, tokens: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n): occurrences in all documents of the given tokens (and of none else)."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(tokens))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                words = Words(data[offsets[first] : offsets[last]], own, NOT_ALNUM, fold=True)
                hashes = words.hashes()
                for wide in range(1, SHINGLE + 1):
                    keys = window_hash(hashes, wide)
                    keys = keys[in_table(known, keys) & words.starts(wide)[: len(keys)]]
                    found, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([as_long(found), pa.array(n.astype(np.int64))], names=["token", "n"])

    counted = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(work, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n")).join(tokens, "token", "left_semi")


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(token, place, n, words, items): each window under its rarest shingle."""
    numbered = windows.withColumn("window", F.xxhash64("words"))
    each = numbered.select("window", "words", F.explode("shingles").alias("s")).select(
        "window", "words", "s.token", "s.place"
    )
    ranked = each.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = ranked.groupBy("words").agg(F.min(F.struct("n", "place", "token")).alias("b"))
    return best.select("words", F.col("b.token").alias("token"), F.col("b.place").alias("place")).join(
        windows.select("words", "items", "n"), "words"
    )


_CANDIDATES = "blob string, n_words long, posts array<struct<token:long,at:int,before:array<string>,after:array<string>>>"


def _posts(shared, names: list[str]):
    """Per row: content name, word count, and the occurrences of prefix tokens with the words around them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        post = pa.struct(
            [
                ("token", pa.int64()),
                ("at", pa.int32()),
                ("before", pa.list_(pa.string())),
                ("after", pa.list_(pa.string())),
            ]
        )
        for batch in batches:
            data, offsets = texts(batch.columns[-1])
            blobs, n_words, posts = [], [], []
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                part = data[offsets[first] : offsets[last]]
                words = Words(part, own, NOT_ALNUM, fold=True)
                raw, kept = words.data.tobytes(), part.tobytes()
                hashes = words.hashes()
                found: dict[int, list[dict]] = {}
                for wide in range(1, SHINGLE + 1):
                    keys = window_hash(hashes, wide)
                    hit = np.flatnonzero(in_table(known, keys) & words.starts(wide)[: len(keys)])
                    rows = np.searchsorted(words.first, hit, side="right") - 1
                    for at, row, token in zip(hit.tolist(), rows.tolist(), keys[hit].view(np.int64).tolist()):
                        lo, hi = int(words.first[row]), int(words.first[row + 1])
                        begin, stop = max(lo, at - WINDOW + wide), min(hi, at + WINDOW)
                        around = [
                            raw[s:e].decode()
                            for s, e in zip(words.start[begin:stop].tolist(), words.end[begin:stop].tolist())
                        ]
                        found.setdefault(row, []).append(
                            {
                                "token": token,
                                "at": at - lo,
                                "before": around[: at - begin],
                                "after": around[at - begin :],
                            }
                        )
                counts = words.counts().tolist()
                for r in range(last - first):
                    blobs.append(hashlib.sha256(kept[own[r] : own[r + 1]]).hexdigest())
                    n_words.append(counts[r])
                    posts.append(found.get(r))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(blobs), pa.array(n_words, pa.int64()), pa.array(posts, pa.list_(post))],
                names=[*names, "blob", "n_words", "posts"],
            )

    return work


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union of the hit ranges of each blob; a blob's ranges are as many as its own hits."""
    for batch in batches:
        sizes = []
        for spans in batch.column(1).to_pylist():
            n, end = 0, -1
            for start, stop in sorted((s["start"], s["stop"]) for s in spans):
                n += max(0, stop - max(start, end))
                end = max(end, stop)
            sizes.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), batch.column(2)], names=["blob", "n_hit", "items"]
        )


NAMES = ("n_words", "n_hit", "items")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_hit (long) and items (sorted ids, array<string>); such columns are replaced.

    The documents are read twice: once to count shingles, once to post occurrences.  What was
    posted is written to the shared folder; texts are never shuffled.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    path = shared_folder(spark, "decontaminate")
    item_windows(benchmark, item_id, item_text).write.parquet(f"{path}/windows")
    windows = spark.read.parquet(f"{path}/windows")
    tokens = windows.select(F.explode("shingles").alias("s")).select(F.col("s.token").alias("token")).distinct()
    prefixes(windows, token_counts(docs, tokens, text_col)).write.parquet(f"{path}/prefixes")
    listed = spark.read.parquet(f"{path}/prefixes")

    source, inner, kept = carried(docs, text_col, NAMES)
    schema = source.select(*inner).schema
    for field in spark.createDataFrame([], _CANDIDATES).schema:
        schema = schema.add(field)
    shared = spark.sparkContext.broadcast(bit_table(listed.select("token").distinct()))
    source.mapInArrow(_posts(shared, inner), schema).write.parquet(f"{path}/posts")
    posted = spark.read.parquet(f"{path}/posts")

    # copies of a text are verified once
    distinct = posted.where(F.col("posts").isNotNull()).select("blob", "n_words", "posts").dropDuplicates(["blob"])
    each = distinct.select("blob", F.col("n_words").alias("length"), F.explode("posts").alias("p"))
    placed = each.join(listed, F.col("p.token") == listed["token"]).withColumn("start", F.col("p.at") - F.col("place"))
    inside = placed.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("length")))
    around = F.concat(
        F.slice("p.before", F.size("p.before") - F.col("place") + 1, F.col("place")),
        F.slice("p.after", F.lit(1), F.col("n") - F.col("place")),
    )
    # the token's place in the window says how many words stand before it
    verified = inside.where((F.size("p.before") >= F.col("place")) & (around == F.col("words")))
    hits = verified.groupBy("blob").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("stop"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    joined_spans = hits.mapInArrow(_hits, "blob string, n_hit long, items array<string>")
    out = posted.drop("posts").join(joined_spans, "blob", "left")
    return out.select(
        *restored(inner, kept),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
