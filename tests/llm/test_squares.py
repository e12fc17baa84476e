"""Periodic runs against their definition."""

import random
import zlib

import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import squares
from tallyweave.llm.queries import QUERIES
from tallyweave.llm.words import Words, texts


def words_of(lists):
    return Words(*texts(pa.array([" ".join(w) for w in lists])))


def drawn(draw, n):
    words = [draw.choice("abcd"[: draw.randrange(1, 5)]) for _ in range(n)]
    if n > 4 and draw.random() < 0.6:
        at = draw.randrange(n)
        period = 1 + (n - at) // draw.randrange(3, 11)
        words = words[:at] + [words[at + (i - at) % period] for i in range(at, n)]
    return words


@pytest.mark.parametrize("exponent,length", [(4, 6), (2, 2), (3, 7)])
@pytest.mark.parametrize("step", [1, 7, squares.STEP])
def test_runs_by_definition(exponent, length, step, monkeypatch):
    monkeypatch.setattr(squares, "STEP", step)
    draw = random.Random(exponent * 100 + step)
    for _ in range(40):
        lists = [drawn(draw, draw.randrange(60)) for _ in range(4)]
        found = squares.find_runs(words_of(lists), exponent, length)
        for own, runs in zip(lists, found):
            assert runs == plain.runs(own, exponent, length)
            assert runs == squares.hash_free_runs([w.encode() for w in own], exponent, length)


def test_words_that_deceive_the_hash(monkeypatch):
    """Where all words hash alike, the words themselves decide."""
    monkeypatch.setattr(Words, "hashes", lambda self, lane=0: self.start.astype("uint64") * 0)
    lists = [list("abcabcabcabcabc"), list("abcdefghijkl"), ["x"] * 9]
    assert squares.find_runs(words_of(lists)) == [[(0, 15, 3)], [], [(0, 9, 1)]]


def test_long_text():
    block = [f"w{i}" for i in range(3000)]
    own = ["a", "b"] + block * 5 + block[:7] + ["end"] + ["z"] * 4000 + ["y", "z"] * 50
    # the last z before the first y goes on with period two as well
    assert squares.find_runs(words_of([own])) == [[(2, 15007, 3000), (15010, 4000, 1), (19009, 101, 2)]]


def test_columns(table, corpus, same):
    out = squares.periodic_runs(table).withColumns(
        {"r": F.expr("transform(runs, r -> array(r.start, r.length, r.period))"), "g": F.expr("greatest.start")}
    )
    rows = []
    for doc_id, text in corpus:
        own = plain.words(text)
        runs = plain.runs(own, 4, 6)
        left = plain.collapsed(own, runs)
        best = plain.greatest_run(runs)
        rows.append((doc_id, len(own), [list(r) for r in runs], best and best[0], " ".join(left), plain.sha(" ".join(left).encode())))
    same(out, ["doc_id", "n_words", "r", "g", "collapsed_text", "collapsed_sha256"], rows)
    assert any(r[2] for r in rows)


def test_odd_tables(clashing, empty, carries):
    out = squares.periodic_runs(clashing)
    carries(clashing, out, ["n_words"])
    assert out.where("text IS NULL").select("n_words", F.size("runs"), "greatest", "collapsed_text").collect() == [(0, 0, None, "")]
    assert squares.periodic_runs(empty).collect() == []


def test_query(spark, same):
    docs = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = []
    for doc_id, text in docs:
        own = plain.words(text)
        n, h = len(own), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
        runs = plain.runs(own, 4, 6)
        start, length, period = plain.greatest_run(runs) or (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        left = " ".join(plain.collapsed(own, runs))
        rows.append((doc_id, len(runs), start, length, period, 1000 * length // period if runs else None, plain.sha(lines.encode()), plain.sha(left.encode())))
    out = QUERIES["op11_runs"](spark, "/root/testdata/sf0.001")
    same(out, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"], rows)
