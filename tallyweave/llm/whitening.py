"""Whitening of embeddings along their leading principal components, by Jacobi-Davidson.

An entry c of a vector becomes the long x = floor(1024 * c) + 100000.  The covariance V of all
x-vectors (divisor n) is never formed: what the solver asks for is V times a few vectors, one
distributed pass in which every task centres its vectors, multiplies and adds up, and
partial sums meet in two steps (``_summed``), each task and the driver holding about the
square root of their number.  The driver keeps the search space only, some ``BASIS`` vectors
of the embeddings' dimension.

Each round projects V on the search space (Rayleigh-Ritz), locks the leading pairs whose
residuals have reached double precision, and expands the space by a correction for every
pair still wanted: the equation (I - QQ')(V - theta I)(I - QQ') t = -r, with the locked and
the wanted vectors in Q, is solved loosely by a few steps of MINRES, all pairs in one pass a
step.  A full space restarts from its best Ritz vectors.  A start at random and guard pairs
below the wanted ones keep leading directions from being missed.

A vector takes part if it is not null, has no null or non-finite entry and the length most of
them have (of two lengths equally frequent the longer); an empty vector does not.  Rows that
do not take part are left out of the result.  Repeated rows count each time.  Components
whose eigenvalue is not above 1e-12 of the trace have no direction in the data
and no rows: none at all for an empty table, one vector, or equal vectors.  An entry whose x is
no long ends the run with an error.  The sum of squares ``deviation`` is a decimal of 38 digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweave.llm.columns import restored
from tallyweave.session import shared_folder

COMPONENTS = 8
#: vectors the search space holds before it restarts, for each wanted pair
BASIS = 12
#: pairs refined beside the wanted ones
GUARDS = 2
#: steps of MINRES for one correction, and the drop of its residual that ends it
INNER, DROP = 5, 0.05
#: a residual of double precision, as a multiple of the greatest eigenvalue
PRECISION = 64 * np.finfo(float).eps
MOST_ROUNDS = 200
#: vectors stored as one block
BLOCK = 1024

Multiply = Callable[[np.ndarray], np.ndarray]


def vectors_of(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x as an integer matrix) of the vectors that may take part, by their length."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    parents = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
    good = lengths > 0
    good[parents[~np.isfinite(values)]] = False
    out = []
    for size in np.unique(lengths[good]).tolist():
        rows = np.flatnonzero(good & (lengths == size))
        taken = np.zeros(len(lengths), bool)
        taken[rows] = True
        x = np.floor(1024 * values[taken[parents]])
        if (np.abs(x) >= 2.0**62).any():
            raise ValueError("an entry of a vector lies beyond the range of a long")
        out.append((rows, x.astype(np.int64).reshape(len(rows), size) + 100_000))
    return out


def store_blocks(vectors: DataFrame, vector_col: str) -> DataFrame:
    """(size, n, block): the x-vectors of ``vectors`` in blocks of bytes, written once for all passes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in vectors_of(batch.column(0)):
                for at in range(0, len(x), BLOCK):
                    part = x[at : at + BLOCK]
                    yield pa.RecordBatch.from_pydict(
                        {"size": pa.array([x.shape[1]], pa.int32()), "n": [len(part)], "block": [part.tobytes()]}
                    )

    path = shared_folder(vectors.sparkSession, "whitening")
    column = F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    vectors.select(column).mapInArrow(work, "size int, n long, block binary").write.parquet(path)
    return vectors.sparkSession.read.parquet(path)


def _summed(blocks: DataFrame, measure: Callable[[np.ndarray], np.ndarray], size: int, parts: int) -> np.ndarray:
    """The sum of ``measure`` (an array of one shape) over all blocks of x-vectors.

    Each task adds its blocks; the partial sums of ``parts`` tasks meet in about sqrt(parts).
    """

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, size)
                found = measure(x)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [np.ascontiguousarray(total).tobytes()]})

    shape = measure(np.zeros((1, size), np.int64))

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros_like(shape), False
        for batch in batches:
            for part in batch.column(0):
                total, some = total + np.frombuffer(part.as_buffer(), shape.dtype).reshape(shape.shape), True
        if some:
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    partial = blocks.select("block").mapInArrow(within, "part binary")
    met = partial.repartition(max(1, math.isqrt(parts))).mapInArrow(between, "part binary")
    total = np.zeros_like(shape)
    for row in met.collect():
        total = total + np.frombuffer(row["part"], shape.dtype).reshape(shape.shape)
    return total


def centred(x: np.ndarray, near: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n in double precision: ``near`` is the integer next to the mean, ``rest`` the mean less it."""
    return (x - near).astype(np.float64) - rest


def minres(apply: Multiply, rhs: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Solve apply(t) = rhs loosely for each column, the columns side by side."""
    tiny = np.finfo(float).tiny
    first = np.linalg.norm(rhs, axis=0)
    t, w, w_old = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    v, v_old = rhs / np.maximum(first, tiny), np.zeros_like(rhs)
    left, beta = first.copy(), np.zeros_like(first)
    cos, sin = -np.ones_like(first), np.zeros_like(first)
    bar, epsilon = np.zeros_like(first), np.zeros_like(first)
    for _ in range(steps):
        p = apply(v) - beta * v_old
        alpha = (v * p).sum(axis=0)
        p -= alpha * v
        beta = np.linalg.norm(p, axis=0)
        before, delta, turn = epsilon, cos * bar + sin * alpha, sin * bar - cos * alpha
        epsilon, bar = sin * beta, -cos * beta
        gamma = np.maximum(np.hypot(turn, beta), tiny)
        cos, sin = turn / gamma, beta / gamma
        w, w_old = (v - before * w_old - delta * w) / gamma, w
        t += cos * left * w
        left = sin * left
        v, v_old = p / np.maximum(beta, tiny), v
        if (left <= drop * first).all():
            break
    return t


def _orthogonal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the span of ``against``."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for other in (*against, *(k[:, None] for k in kept)):
                column = column - other @ (other.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-10:
            column = column / size
            for other in (*against, *(k[:, None] for k in kept)):
                column = column - other @ (other.T @ column)
            kept.append(column / np.linalg.norm(column))
    return np.array(kept).T if kept else block[:, :0]


def leading_pairs(multiply: Multiply, size: int, wanted: int, precision: float = PRECISION) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``wanted`` greatest eigenvalues of a symmetric operator, falling."""
    wanted = min(wanted, size)
    most = max(min(size, BASIS * wanted), wanted + GUARDS + 1)
    start = np.random.default_rng(20240229).standard_normal((size, min(size, 2 * wanted)))
    space = _orthogonal(start)
    image = multiply(space)
    locked = np.zeros((size, 0))
    scale = 0.0
    for _ in range(MOST_ROUNDS):
        projected = space.T @ image
        values, turns = np.linalg.eigh((projected + projected.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        scale = max(scale, float(np.abs(values).max(initial=0)))
        open_ = wanted - locked.shape[1]
        near = min(open_ + GUARDS, len(values))
        ritz = space @ turns[:, :near]
        residual = image @ turns[:, :near] - ritz * values[:near]
        residual -= locked @ (locked.T @ residual)
        settled = np.linalg.norm(residual, axis=0) <= precision * scale
        done = int(np.argmin(settled)) if not settled.all() else near  # the leading ones, in order
        done = min(done, open_)
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            space, image = space @ turns[:, done:], image @ turns[:, done:]
            if locked.shape[1] == wanted:
                break
            values, ritz, residual = values[done:], ritz[:, done:], residual[:, done:]
        elif space.shape[1] + ritz.shape[1] > most and space.shape[1] + locked.shape[1] < size:
            keep = min(2 * (wanted + GUARDS), space.shape[1])
            space, image = space @ turns[:, :keep], image @ turns[:, :keep]
        if not ritz.shape[1] or space.shape[1] + locked.shape[1] >= size:
            # the whole space is spanned: a fresh image of it is as good as products get
            space = _orthogonal(np.column_stack([space, np.eye(size)]), locked)
            image = multiply(space)
            precision *= 2
            continue
        outside, shift = np.column_stack([locked, ritz]), values[: ritz.shape[1]]

        def project(block: np.ndarray) -> np.ndarray:
            return block - outside @ (outside.T @ block)

        def shifted(block: np.ndarray) -> np.ndarray:
            block = project(block)
            return project(multiply(block) - block * shift)

        correction = minres(shifted, -project(residual), INNER, DROP)
        fresh = _orthogonal(np.column_stack([correction, residual]), locked, space)[:, : size - space.shape[1] - locked.shape[1]]
        if not fresh.shape[1]:
            fresh = _orthogonal(np.random.default_rng(space.shape[1]).standard_normal((size, 1)), locked, space)
        fresh = fresh[:, : max(correction.shape[1], 1)]
        space, image = np.column_stack([space, fresh]), np.column_stack([image, multiply(fresh)])
    else:
        raise RuntimeError("eigenpairs have not settled")
    projected = locked.T @ multiply(locked)
    values, turns = np.linalg.eigh((projected + projected.T) / 2)
    return values[::-1], locked @ turns[:, ::-1]


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` found; ``directions[:, j]`` is component j + 1, ``values[j]`` its variance."""

    n: int
    size: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    directions: np.ndarray
    identity_error: float
    #: products of the covariance with a block of vectors that the solver took
    products: int

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        return _centre(self.n, self.sums)

    def scale(self) -> np.ndarray:
        return self.directions / np.sqrt(self.values)


def _centre(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    near = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(near, np.int64), np.array([(s - n * m) / n for s, m in zip(sums, near)])


NOTHING = Whitening(0, 0, (), 0.0, np.zeros(0), np.zeros((0, 0)), 0.0, 0)


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on every vector that takes part."""
    blocks = store_blocks(vectors, vector_col)
    counted = blocks.groupBy("size").agg(F.sum("n").alias("n"))
    common = counted.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return NOTHING
    size, n = common["size"], common["n"]
    blocks = blocks.where(F.col("size") == size)
    parts = blocks.rdd.getNumPartitions()
    # high and low halves: their sums stay within a long
    halves = _summed(blocks, lambda x: np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]), size, parts)
    sums = tuple((int(high) << 32) + int(low) for high, low in halves.T)
    near, rest = _centre(n, sums)
    products = 0

    def multiply(block: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1

        def measure(x: np.ndarray) -> np.ndarray:
            c = centred(x, near, rest)
            return c.T @ (c @ block)

        return _summed(blocks, measure, size, parts) / n

    trace = float(_summed(blocks, lambda x: np.array([(centred(x, near, rest) ** 2).sum()]), size, parts)[0]) / n
    if trace == 0:
        return NOTHING
    values, directions = leading_pairs(multiply, size, components)
    some = values > 1e-12 * trace
    values, directions = values[some], directions[:, some]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    model = Whitening(n, size, sums, trace, values, directions, 0.0, products)
    scale = model.scale()

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x, near, rest) @ scale
        return np.vstack([w.sum(axis=0)[None], w.T @ w])

    found = _summed(blocks, moments, size, parts) / n
    error = found[1:] - np.outer(found[0], found[0]) - np.eye(len(values))
    return Whitening(n, size, sums, trace, values, directions, float(np.abs(error).max()), products)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """The exact sum of (n * x - S)^2 over each row's dimensions."""
    near, _ = _centre(n, sums)
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    y = x - near
    widest = n * (int(np.abs(y).max(initial=0)) + 1)
    kind = pa.decimal128(38, 0)
    if widest * widest * len(sums) < 2**63:
        return pa.array((((n * y) - np.array(rest, np.int64)) ** 2).sum(axis=1)).cast(kind)
    # of unbounded integers
    whole = ((y.astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1)
    return pa.array([Decimal(v) for v in whole], kind)


NAMES = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def whiten(vectors: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each component from 1 on.

    Carries the other columns of ``vectors``; columns named like an output are replaced.
    """
    taken = {*NAMES, vector_col.lower()}
    kept = [c for c in vectors.columns if c.lower() not in taken]
    inner = [f"c{i}" for i in range(len(kept))]
    source = vectors.select(
        *[F.col(f"`{c}`").alias(i) for c, i in zip(kept, inner)],
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    schema = source.select(*inner).schema
    for name, kind in zip(NAMES, ("integer", "long", T.DecimalType(38, 0), "double", "double", "double")):
        schema = schema.add(name, kind)
    count = len(model.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, rest = model.centre()
        scale = model.scale()
        explained = model.values / model.trace if count else model.values
        for batch in batches:
            for rows, x in vectors_of(batch.columns[-1]):
                if x.shape[1] != model.size or not count:
                    continue
                each = np.repeat(np.arange(len(rows)), count)
                columns = [
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), model.n, np.int64)),
                    deviations(x, model.n, model.sums).take(pa.array(each)),
                    pa.array((centred(x, near, rest) @ scale).ravel()),
                    pa.array(np.tile(explained, len(rows))),
                    pa.array(np.full(len(each), model.identity_error)),
                ]
                own = [c.take(pa.array(rows[each])) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[*inner, *NAMES])

    return source.mapInArrow(work, schema).select(*restored(inner, kept), *NAMES)
