"""A quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts.  A text
is cut into blocks, each block is compressed with either dictionary, and the difference of the two
summed sizes over the text's own size says which dictionary knows it better: bytes that
either one shrinks to nothing, as in endless repetition, add nothing to the difference but all
of their length to what it is divided by.  Blocks keep the dictionaries' influence alike in
short and long texts, and all blocks count.  A logistic curve over this one number, fitted on
labelled texts that neither dictionary has seen, turns it into a score between 0 and 1.

Fitting takes a bounded sample (``FitLimits``) of the labelled rows: those of least hash, half
for the dictionaries, half for the curve.  Scoring covers every row where it is read, without
a shuffle.  Nulls are empty texts; an empty text has difference 0, which gives it the curve's
value there.  Without labels of both classes no score can be learned and every score is 0.5.
Copies of a text count once in fitting, and a text labelled both ways counts as bad; a label without
document, or without value, counts for nothing.  Equal rows get equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.samples import labelled_sample

BLOCK_BYTES = 1024
_LEVEL = 3


@dataclass(frozen=True)
class FitLimits:
    """Bounds of what the driver fits on."""

    #: labelled texts of each class
    texts: int = 1200
    #: bytes of the longest text taken; longer ones are left to scoring
    text_bytes: int = 24_576
    #: bytes of a dictionary
    dictionary: int = 65_536


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def scores(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.offset, -40, 40)))


class _Pair:
    """Compressors of the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(
            _LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.both = []
        for content in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(content)
            dictionary.precompute_compress(level=_LEVEL)
            self.both.append(zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary))

    def difference(self, text: bytes) -> float:
        """Above 0 where the good dictionary compresses better."""
        good = bad = 0
        for at in range(0, len(text), BLOCK_BYTES):
            block = text[at : at + BLOCK_BYTES]
            good += len(self.both[0].compress(block))
            bad += len(self.both[1].compress(block))
        return (bad - good) / max(len(text), 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Weights of the columns of ``x`` and the offset, by Newton's method with a small ridge."""
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([0.05] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + ridge @ w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if float(np.abs(step).max()) < 1e-8:
            break
    return (*(w[:-1] / scale).tolist(), float(w[-1]))


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    total = sum(map(len, texts))
    try:
        return zstandard.train_dictionary(min(size, max(total // 4, 256)), texts, level=_LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:] or b" "


def fit(
    docs: DataFrame,
    labels: DataFrame,
    limits: FitLimits = FitLimits(),
    key: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
) -> CompressionModel:
    """Fit on a bounded sample of the documents that ``labels`` marks 0 or 1."""
    sample = labelled_sample(docs, labels, limits.texts, limits.text_bytes, key, text_col, label_col)
    taken = {label: [t.encode() for t in found] for label, found in sample.items()}
    if not taken[0] or not taken[1]:
        return CompressionModel(b" ", b" ", 0.0, 0.0)
    good = _dictionary(taken[1][::2], limits.dictionary)
    bad = _dictionary(taken[0][::2], limits.dictionary)
    pair = _Pair(good, bad)
    rest = [(t, label) for label in (0, 1) for t in taken[label][1::2] or taken[label]]
    x = np.array([[pair.difference(t)] for t, _ in rest])
    y = np.array([label for _, label in rest], float)
    return CompressionModel(good, bad, *fit_logistic(x, y))


def score_documents(docs: DataFrame, model: CompressionModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score per row; a column of that name is replaced."""
    source, inner, kept = carried(docs, text_col, [name])
    schema = source.select(*inner).schema.add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        pair = _Pair(fitted.good, fitted.bad)
        for batch in batches:
            found = [pair.difference(t.encode() if t else b"") for t in _each(batch.columns[-1])]
            scores = fitted.scores(np.array(found, float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], names=[*inner, "score"])

    return source.mapInArrow(work, schema).select(*restored(inner, kept), F.col("score").alias(name))


def _each(column: pa.Array) -> Iterator[str | None]:
    """Values one by one: a batch of long texts is not held twice."""
    for value in column:
        yield value.as_py()


def log_loss(scores: list[float], labels: list[int]) -> float:
    """Mean negative log-likelihood, for held-out checks."""
    return -sum(math.log(max(1e-12, s if y else 1 - s)) for s, y in zip(scores, labels)) / max(len(labels), 1)
