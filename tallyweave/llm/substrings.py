"""Removal of word windows that occur more than once in a corpus.

1. Every task sketches the anchors of its windows; the merged count-min sketch (``repeats``)
   overestimates how often a window occurs.
2. Windows estimated repeated are grouped by a hash of their whole word sequence (96 bits).
   Partial counts keep a window of any frequency from filling a task.  What comes out are the
   false alarms: windows that occur once, each with the one text that holds it.
3. Every text drops the words covered by its estimated windows, but for its false alarms.

A window estimated once occurs once, so no repeated window is lost; one estimated repeated is
removed only if the second pass has counted it twice.  Texts are told apart by content: a text
held by two rows has no window that occurs once.

Null and empty texts have no words.  Equal rows are copies of one another and lose every
window.  The result has a row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.repeats import anchors, estimated_repeated, repeated_cells, sketch_bits, text_bytes
from tallyweave.llm.words import U64, Words, as_long, chunks, covered, texts, window_hash

WINDOW = 35
GRAM = 12
# about one anchor in (WINDOW - GRAM + 2) / 2 words of some six bytes
_BYTES_PER_ANCHOR = 70


@dataclass
class _Windows:
    words: Words
    hashes: np.ndarray
    valid: np.ndarray
    least: np.ndarray
    chosen: np.ndarray


def _analyse(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> _Windows:
    words = Words(data, offsets)
    hashes = words.hashes()
    valid = words.starts(window)
    least, chosen = anchors(window_hash(hashes, gram), valid, window - gram + 1)
    return _Windows(words, hashes, valid, least, chosen)


def _estimated(found: _Windows, table: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the windows estimated repeated."""
    starts = np.flatnonzero(found.valid)
    return starts[estimated_repeated(table, found.least[starts], bits)]


NAMES = ("n_words", "n_removed", "kept_text", "kept_sha256")


def remove_repeats(
    docs: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    bits: int | None = None,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with n_words, n_removed (long), kept_text (words joined by a space) and kept_sha256.

    Columns of those names are replaced.  ``bits`` sets the sketch's size; by default it follows
    the corpus.  ``with_text=False`` leaves out kept_text.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram is a part of its window")
    spark = docs.sparkSession
    if bits is None:
        bits = sketch_bits(text_bytes(docs, text_col) // _BYTES_PER_ANCHOR)

    def anchors_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words = Words(data, offsets)
        grams = window_hash(words.hashes(), gram)
        return grams[anchors(grams, words.starts(window), window - gram + 1)[1]]

    shared = spark.sparkContext.broadcast(repeated_cells(docs, anchors_of, bits, text_col))

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            names = batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = texts(batch.column(0))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                found = _analyse(data[offsets[first] : offsets[last]], own, window, gram)
                starts = _estimated(found, table, bits)
                if not len(starts):
                    continue
                row = np.searchsorted(found.words.first, starts, side="right") - 1
                low = window_hash(found.words.hashes(1), window, 1)[starts] >> U64(32)
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(window_hash(found.hashes, window)[starts]),
                        pa.array(low.astype(np.uint32).view(np.int32)),
                        pa.array(names[first + row]),
                        pa.array((starts - found.words.first[row]).astype(np.int32)),
                    ],
                    names=["high", "low", "name", "at"],
                )

    named = docs.select(F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{text_col}`").alias("name"))
    once = (
        named.mapInArrow(estimated, "high long, low int, name long, at int")
        .groupBy("high", "low")
        .agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"), F.min("at").alias("at"))
        .where("n = 1")
        .groupBy("name")
        .agg(F.collect_list("at").alias("once"))
    )

    carry, inner, kept = carried(docs, text_col, NAMES)
    outputs = [n for n in NAMES if with_text or n != "kept_text"]
    source = carry.withColumn("name", F.xxhash64("text")).join(once, "name", "left")
    source = source.select(*inner, "text", "once")
    schema = source.select(*inner).schema
    for name in outputs:
        schema = schema.add(name, "long" if name.startswith("n_") else "string")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            data, offsets = texts(batch.column(len(inner)))
            alone = batch.column(len(inner) + 1)
            made: dict[str, list] = {name: [] for name in outputs}
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                found = _analyse(data[offsets[first] : offsets[last]], own, window, gram)
                heads = found.words.first
                repeated = np.zeros(len(found.words.start), bool)
                repeated[_estimated(found, table, bits)] = True
                for r in range(first, last):
                    if alone[r].is_valid:
                        repeated[alone[r].values.to_numpy() + heads[r - first]] = False
                gone = covered(np.flatnonzero(repeated), window, len(repeated))
                raw, keep = found.words.data.tobytes(), ~gone
                for r in range(last - first):
                    lo, hi = int(heads[r]), int(heads[r + 1])
                    words = raw[own[r] : own[r + 1]].split()
                    left = keep[lo:hi]
                    n_left = int(left.sum())
                    if n_left == hi - lo:
                        text = b" ".join(words)
                    else:
                        text = b" ".join([words[i] for i in np.flatnonzero(left).tolist()])
                    made["n_words"].append(hi - lo)
                    made["n_removed"].append(hi - lo - n_left)
                    made["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        made["kept_text"].append(text.decode())
            columns = [pa.array(made[n], pa.int64() if n.startswith("n_") else pa.string()) for n in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(inner)], *columns], names=[*inner, *outputs])

    out = source.mapInArrow(removed, schema)
    return out.select(*restored(inner, kept), *outputs)
