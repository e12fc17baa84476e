"""Count-min sketches of window anchors: which windows may occur more than once.

The windows of a text are its runs of ``width`` items (words or bytes).  Among the shorter
runs of ``gram`` items inside a window, the one of least hash is its *anchor*.  Equal windows
have equal anchors at the same distance, so a window occurs at most as often as its anchor, and
neighbouring windows mostly share one: counting anchors instead of windows bounds every
window's count from above with a fraction of the counters.

Each task counts the anchors of its texts into the cells of a count-min sketch of two rows;
cells are summed over all tasks, and what is kept is one bit per cell: two or more.  An
anchor is *estimated repeated* when both of its cells are.  The estimate never misses a
repeated window; false alarms depend on how full the sketch is and only cost work.  The
sketch has a fixed size of 2^(bits - 2) bytes, chosen from the corpus's size between stated
bounds, whatever is counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import modest_batches
from tallyweave.llm.words import U64, chunks, mix, sliding, texts

LEAST_BITS, MOST_BITS = 20, 28


def anchors(grams: np.ndarray, valid: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The least gram of each window, and flags of the grams that are least in some window.

    ``grams`` holds the hash of the gram at each item, ``valid`` flags the starts of windows and
    ``span`` is the number of grams in a window.  Values at other starts are 0.
    """
    n = len(valid)
    padded = np.full(n + span - 1, np.iinfo(np.uint64).max, U64)
    padded[: len(grams)] = grams
    least = np.where(valid, sliding(np.minimum, padded, span)[:n], U64(0))
    back = np.zeros(n + span - 1, U64)
    back[span - 1 :] = least
    chosen = sliding(np.maximum, back, span)[: len(grams)] == grams
    return least, chosen & (grams != 0)


def sketch_bits(items: int) -> int:
    """Cells per row for about ``items`` counted anchors, four to eight for each."""
    return int(min(max((4 * max(items, 1)).bit_length(), LEAST_BITS), MOST_BITS))


def cells(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each key in either row of the sketch."""
    shift = U64(64 - bits)
    return keys >> shift, (mix(keys ^ U64(0x5851F42D4C957F2D)) >> shift) + U64(1 << bits)


def repeated_cells(
    docs: DataFrame, anchors_of: Callable[[np.ndarray, np.ndarray], np.ndarray], bits: int, text_col: str = "text"
) -> np.ndarray:
    """The merged sketch as a bit table; ``anchors_of`` gives the anchor keys of a chunk of texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                keys = anchors_of(data[offsets[first] : offsets[last]], own)
                found, n = np.unique(np.concatenate(cells(keys, bits)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int64)), pa.array(np.minimum(n, 2).astype(np.int32))], names=["cell", "n"]
                )

    modest_batches(docs.sparkSession)
    counted = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(work, "cell long, n int")
    return bit_table(counted.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell"), bits + 1)


def bit_table(found: DataFrame, bits: int) -> np.ndarray:
    """A column of cells below 2^bits as bits; 2^bits / 4 bytes reach the driver at most."""
    packed = (
        found.groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(cell % 64 AS INT))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros((1 << bits) // 64, np.int64)
    out[packed.column("word").to_numpy()] = packed.column("bits").to_numpy()
    return out.view(U64)


def has_bit(table: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (table[cell >> U64(6)] >> (cell & U64(63))) & U64(1) == 1


def estimated_repeated(table: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    one, two = cells(keys, bits)
    return has_bit(table, one) & has_bit(table, two)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """The bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(f"`{text_col}`")), F.lit(0))).first()[0]
