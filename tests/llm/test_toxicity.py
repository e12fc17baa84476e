"""The subsequence kernel by its definition, scoring as a kernel expansion, held-out labels, odd tables."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import toxicity as tx
from tallyweave.llm.queries import QUERIES

INSULTS = ["blorfel", "snarkod", "wumpit"]


def plain_kernel(one, two):
    """Sum over all pairs of equal subsequences, each weighed by the symbols it skips."""

    def each(s):
        for at in combinations(range(len(s)), tx.LENGTH):
            if at[-1] - at[0] < tx.SPAN:
                yield tuple(s[i] for i in at), tx.DECAY ** (at[-1] - at[0] + 1 - tx.LENGTH)

    return sum(v * w for a, v in each(one) for b, w in each(two) if a == b)


def test_kernel_by_definition():
    draw = random.Random(1)
    for _ in range(30):
        one, two = ([draw.randrange(1, 4) for _ in range(draw.randrange(12))] for _ in range(2))
        found = tx.kernel(tx.features(np.array(one, int), len(one)), tx.features(np.array(two, int), len(two)))
        assert found == pytest.approx(plain_kernel(one, two))


def made(count, seed, toxic):
    draw = random.Random(seed)
    words = ["thing", "over", "sand", "mill", "garden", "stone", "after", "winter", "spoken", "bread", "los", "pump"]
    out = []
    for _ in range(count):
        own = [[draw.choice(words) for _ in range(draw.randrange(4, 12))] for _ in range(draw.randrange(2, 8))]
        if toxic:
            draw.choice(own).insert(2, draw.choice(INSULTS))
        out.append(". ".join(" ".join(s) for s in own) + ".")
    return out


@pytest.fixture(scope="module")
def model():
    return tx.fit_texts(made(200, 1, False), made(200, 2, True))


def scores(model, texts):
    return model.scores(tx.Sentences(texts).best(model.weights))


def test_windows_are_kernel_sums(model):
    """A window's weight is the sum over its subsequences, those of no other sentence."""
    texts = ["Idiots, they said.  Ärgern! a-b c", "", "\n", "one. two", "x" * 40, "ŁÓDŹ 字かな 🙂 12"]
    sentences = tx.Sentences(texts)
    weights = np.random.default_rng(1).standard_normal(1 << 20).astype(np.float32)
    weights[[k for k in range(1 << 20) if 0 in (k >> 15, k >> 10 & 31, k >> 5 & 31, k & 31)]] = 0
    sums = sentences.sums(weights)
    for row, text in enumerate(texts):
        best = 0.0
        for at in range(sentences.rows[row], sentences.rows[row + 1]):
            own = tx.features(sentences.symbols[at : at + tx.WINDOW + tx.SPAN - 1], tx.WINDOW)
            expected = sum(w * weights[k] for k, w in own.items())
            assert sums[at] == pytest.approx(expected, abs=1e-4)
            best = max(best, expected)
        assert sentences.best(weights)[row] == pytest.approx(best, abs=1e-4)


def test_folding_is_the_expansion():
    words = [(28, *[ord(c) - 96 for c in w], 28) for w in INSULTS]
    space = tx.Nystroem(words)
    direction = np.random.default_rng(2).standard_normal(space.root.shape[1])
    window = tx.features(tx.Sentences(["a snarkkod b"]).symbols, 30)
    weights = space.fold(direction)
    folded = sum(w * weights[k] for k, w in window.items())
    assert folded == pytest.approx(float(space.map([window])[0] @ direction), abs=1e-5)


def test_machine_separates():
    draw = np.random.default_rng(3)
    x = draw.standard_normal((300, 5))
    y = (x[:, 0] - x[:, 3] > 0.2).astype(int)
    direction, offset = tx.machine(x, y, cost=100.0)
    assert ((x @ direction + offset > 0) == y).mean() > 0.97


def test_insults_and_their_disguises(model):
    clean = made(100, 5, False)
    assert (scores(model, clean) < 0.5).mean() >= 0.95
    assert (scores(model, made(100, 6, True)) >= 0.5).mean() >= 0.98
    disguises = [w.upper() for w in INSULTS] + [w[:3] + "x" + w[3:] for w in INSULTS] + [w[:4] + "*" + w[4:] for w in INSULTS]
    disguises += [" ".join(w) for w in INSULTS] + ["-".join(w) for w in INSULTS] + ["ß" + w for w in INSULTS]
    found = scores(model, [f"the mill of {w} spoken after winter" for w in disguises])
    assert (found >= 0.5).mean() >= 0.7


def test_long_text(model):
    clean = " ".join(made(4000, 7, False))
    low, high = scores(model, [clean, clean[: len(clean) // 2] + " blorfel " + clean[len(clean) // 2 :]])
    assert low < 0.5 <= high


def test_held_out_labels(spark):
    """Held-out rows of the given labels, which hold some noise and few toxic texts in some languages."""
    sf_dir = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = QUERIES["op12_toxicity"](spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = out.where("held_out").join(marks, "doc_id").collect()
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    toxic = np.array([r["score"] for r in rows if r["toxic"]])
    clean = np.array([r["score"] for r in rows if not r["toxic"]])
    assert (toxic[:, None] > clean[None]).mean() > 0.9
    assert (toxic >= 0.5).mean() > 0.7 and (clean >= 0.5).mean() < 0.05


def test_odd_tables(spark, clashing, empty, carries):
    rows = [(i, t, 0) for i, t in enumerate(made(60, 1, False))] + [(100 + i, t, 1) for i, t in enumerate(made(60, 2, True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    marks = docs.select("doc_id", "label").union(spark.createDataFrame([(None, 1), (3, None), (4, 7), (99999, 1)], "doc_id long, label int"))
    model = tx.fit(docs, marks)
    assert model.weights.any()
    out = tx.score_documents(clashing, model)
    carries(clashing, out, ["score"])
    same = out.groupBy("text").agg(F.countDistinct("score").alias("k")).collect()
    assert all(r["k"] == 1 for r in same)
    nothing = out.where("text IS NULL OR text = ''").select("score").distinct().collect()
    assert len(nothing) == 1 and nothing[0][0] < 0.5
    assert tx.score_documents(empty, model).collect() == []
    for few in (marks.where("label = 0"), marks.where("label = 1"), marks.where("false")):
        none = tx.fit(docs, few)
        assert {r["score"] for r in tx.score_documents(docs, none).collect()} == {0.0}
