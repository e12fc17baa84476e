"""Jacobi-Davidson against a dense solver, whitened rows against the definition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import whitening
from tallyweave.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def spectrum(kind, size, draw):
    if kind == "flat":
        return 1 + 0.01 * draw.random(size)
    if kind == "twins":
        return np.repeat(draw.random((size + 1) // 2) + 0.1, 2)[:size]
    if kind == "steep":
        return 10.0 ** -np.arange(size).clip(0, 12)
    return draw.random(size)


@pytest.mark.parametrize("kind", ["flat", "twins", "steep", "even"])
@pytest.mark.parametrize("size", [1, 5, 9, 64, 300])
def test_leading_pairs(kind, size):
    draw = np.random.default_rng(size)
    turn, _ = np.linalg.qr(draw.standard_normal((size, size)))
    matrix = (turn * spectrum(kind, size, draw)) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_pairs(lambda block: matrix @ block, size, 8)
    best = np.linalg.eigvalsh(matrix)[::-1][:8]
    assert np.abs(values - best).max() < 1e-13 * best[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * best[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_minres_solves():
    draw = np.random.default_rng(1)
    a = draw.standard_normal((30, 30))
    a = a + a.T
    rhs = draw.standard_normal((30, 4))
    assert np.abs(a @ whitening.minres(lambda b: a @ b, rhs, 200, 1e-13) - rhs).max() < 1e-8


def plain_whitening(vectors):
    """(n, S, deviations, whitened, explained) by the definition, with a dense solver."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    c = np.array([[n * a - s for a, s in zip(v, sums)] for v in x], float) / n
    values, turns = np.linalg.eigh(c.T @ c / n)
    values, turns = values[::-1][:8], turns[:, ::-1][:, :8]
    return n, deviation, c @ turns / np.sqrt(values), values / (c**2).sum() * n


def check(rows, ids, vectors):
    n, deviation, whitened, explained = plain_whitening(vectors)
    place = {i: k for k, i in enumerate(ids)}
    count = whitened.shape[1]
    assert len(rows) == len(ids) * count
    made = np.zeros_like(whitened)
    for r in rows:
        k, j = place[r["vec_id"]], r["component"] - 1
        assert (r["n"], int(r["deviation"])) == (n, deviation[k])
        assert r["explained"] == pytest.approx(explained[j], rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9
        made[k, j] = r["whitened"]
    for j in range(count):
        sign = np.sign((made[:, j] * whitened[:, j]).sum())
        assert np.abs(sign * made[:, j] - whitened[:, j]).max() < 1e-8


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    check(QUERIES["op13_whitening"](spark, SF_DIR).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(3)
    good = {i: draw.standard_normal(4).tolist() for i in range(50)}
    odd = {100: None, 101: [1.0, None, 2.0, 3.0], 102: [1.0, float("nan"), 0.0, 0.0], 103: [float("inf"), 0.0, 0.0, 0.0], 104: [], 105: [1.0, 2.0]}
    rows = [(i, v, "x") for i, v in {**good, **odd}.items()] + [(7, good[7], None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").repartition(3)
    model = whitening.fit(table)
    assert model.n == 51 and model.size == 4 and model.products > 0
    out = whitening.whiten(table, model)
    assert out.columns == ["vec_id", *whitening.NAMES]
    found = out.where("vec_id <> 7").collect()
    assert {r["vec_id"] for r in found} == set(good) - {7} and len(found) == 49 * 4
    again = out.where("vec_id = 7").groupBy("component").agg(F.count("*").alias("n"), F.countDistinct("whitened").alias("k")).collect()
    assert sorted((r["component"], r["n"], r["k"]) for r in again) == [(j, 2, 1) for j in (1, 2, 3, 4)]
    n, deviation, _, _ = plain_whitening([*good.values(), good[7]])
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == {i: d for i, d in zip(good, deviation) if i != 7}


def test_large_numbers(spark):
    """Sums and squares beyond a long stay exact."""
    rows = [(i, [1e12 * (i + 1), -1e11 * i * i, float(i % 3)]) for i in range(9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(table)
    found = whitening.whiten(table, model).where("component = 1").collect()
    n, deviation, _, _ = plain_whitening([v for _, v in rows])
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == dict(enumerate(deviation))
    assert max(deviation) > 2**63


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)]])
def test_no_directions(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(table)
    assert len(model.values) == 0 and whitening.whiten(table, model).collect() == []
