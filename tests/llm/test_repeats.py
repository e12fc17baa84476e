"""Substring and suffix removal, near duplicates and decontamination against plain Python."""

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import suffixes
from tallyweave.llm.components import components
from tallyweave.llm.decontaminate import decontaminate
from tallyweave.llm.near_dups import COORDINATES, MISSED, least_matches, linked, near_duplicates
from tallyweave.llm.substrings import remove_repeats
from tallyweave.llm.suffixes import remove_repeated_bytes
from tallyweave.llm.words import Words


@pytest.mark.parametrize("bits", [None, 10], ids=["sized", "overfull"])
def test_substrings(table, corpus, same, bits):
    out = remove_repeats(table, bits=bits)
    same(out, ["doc_id", "n_words", "n_removed", "kept_sha256"], plain.substrings(corpus))


def test_substrings_text_is_what_is_hashed(table):
    out = remove_repeats(table)
    assert out.where(F.sha2("kept_text", 256) != F.col("kept_sha256")).isEmpty()


@pytest.mark.parametrize(("bits", "crowd"), [(None, 4096), (12, 2)], ids=["sized", "overfull_crowds"])
def test_suffixes(table, corpus, same, bits, crowd):
    out = remove_repeated_bytes(table, bits=bits, crowd=crowd)
    same(out, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], plain.suffixes(corpus))


def test_suffixes_of_long_texts_in_pieces(spark, same, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 300)
    rows = [(1, "".join(f"{i * i % 997} " for i in range(1500))), (2, "".join(f"{i * i % 997} " for i in range(700, 1600)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    same(remove_repeated_bytes(df), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], plain.suffixes(rows))


def test_merge_sort_orders_strings():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 99, 3000).astype(np.uint8)
    at = draw.integers(0, 2900, 500)
    segment = np.sort(draw.integers(0, 9, 500))
    order = suffixes.merge_sort(data, at, segment, 60)
    expected = sorted(range(500), key=lambda i: (segment[i], data[at[i] : at[i] + 60].tobytes()))
    assert order.tolist() == expected


def test_a_lying_hash_is_found_out(monkeypatch):
    monkeypatch.setattr(suffixes, "range_hash", lambda prefix, a, b, lane=0: np.zeros(len(a), np.uint64))
    data = np.frombuffer(b"aaaabbbbaaaacccc", np.uint8)
    flags = suffixes.repeated_starts(data, np.array([0, 4, 8, 12]), np.zeros(4, np.int64), 4)
    assert flags.tolist() == [True, False, True, False]


def test_near_duplicates(spark, corpus, same):
    rows = [r for r in corpus if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = plain.near_duplicates(rows)
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    same(near_duplicates(df), columns, expected)
    same(near_duplicates(df, block=3), columns, expected)


def test_near_duplicates_of_a_chain(spark, same):
    """Texts that differ from the next one by a few words are one component, whatever the block."""
    tokens = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(40):
        rows.append((100 - k, " ".join(tokens)))
        tokens = tokens[3:] + [f"x{k}a", f"x{k}b", f"x{k}c"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(near_duplicates(df, block=8), ["doc_id", "n_shingles", "component_id", "kept"], plain.near_duplicates(rows))


def similar(count, seed):
    """Texts in families whose members share anything from a third to all of their words in order."""
    import random

    draw = random.Random(seed)
    rows = []
    for family in range(count):
        base = [f"f{family}w{i}" for i in range(draw.randrange(30, 120))]
        for _ in range(6):
            own = list(base)
            for _ in range(draw.randrange(0, 14)):
                own[draw.randrange(len(own))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(own[: draw.randrange(len(own) // 2, len(own)) + 1])))
    return rows


@pytest.mark.parametrize("percent,width", [(50, 3), (70, 3), (80, 5), (85, 3), (100, 2)])
def test_near_duplicates_at_any_similarity(spark, same, percent, width):
    rows = similar(40, percent)
    rows += [(1000 + i, text) for i, text in rows[:5]] + [(2000, " ".join(reversed(rows[0][1].split())))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = plain.near_duplicates(rows, width, percent)
    assert 0 < sum(not r[3] for r in expected)
    same(near_duplicates(df, percent=percent, width=width, block=16), ["doc_id", "n_shingles", "component_id", "kept"], expected)


def test_matches_follow_the_similarity():
    from math import comb

    for percent in (25, 50, 70, 80, 85, 95):
        p, m = percent / 100, least_matches(percent)
        missed = sum(comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k) for k in range(m))
        assert missed <= MISSED < missed + comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
    assert least_matches(100) == COORDINATES
    with pytest.raises(ValueError):
        least_matches(24)


def test_texts_that_share_a_passage_do_not_meet(spark):
    """Below the similarity asked for, texts with a common passage are neither posted nor compared in pairs."""
    import random
    import time

    draw = random.Random(5)
    shared = [f"s{i}" for i in range(110)]

    def seconds(count):
        rows = [(i, " ".join(shared + [f"o{draw.randrange(10**9)}" for _ in range(90)])) for i in range(count)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
        start = time.perf_counter()
        assert near_duplicates(df).where("kept").count() == count
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8000) < 3 * seconds(1000) + 10


def test_links_are_exact():
    a = np.arange(100, dtype=np.uint64)
    assert linked([a, a[:85], a[:84]], 85) == [(0, 1), (1, 2)]
    assert linked([a, a[:84], a[50:]], 85) == []


def test_components(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(spark.range(300, 310).selectExpr("id AS a", "300L AS b"))
    found = {r["node"]: r["root"] for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 300 for i in range(300, 310)}}


def test_decontaminate(spark, table, corpus, same):
    items = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900, "Two three"), (901, ""), (902, None), (903, corpus[9][1][50:200]), (904, corpus[9][1][50:200])]
    out = decontaminate(table, spark.createDataFrame(items, "item_id long, text string"))
    same(out, ["doc_id", "n_words", "n_hit", "items"], plain.contamination(corpus, items))


def test_words_of_rows():
    raw = [b"", b"ab  c", b"d", b"", b" \n", b"e"]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    found = Words(data, offsets)
    assert found.counts().tolist() == [0, 2, 1, 0, 0, 1]
    assert [bytes(data[s:e]) for s, e in zip(found.start, found.end)] == [b"ab", b"c", b"d", b"e"]


@pytest.mark.parametrize(
    ("apply", "replaced"),
    [
        (lambda df: remove_repeats(df), ("n_words",)),
        (lambda df: remove_repeated_bytes(df), ()),
        (lambda df: decontaminate(df, df.select(F.col("doc_id").alias("item_id"), "text")), ("n_words",)),
    ],
    ids=["substrings", "suffixes", "decontaminate"],
)
def test_clashing_columns_and_empty_tables(clashing, empty, carries, apply, replaced):
    carries(clashing, apply(clashing), replaced)
    assert apply(empty).isEmpty()


def test_near_duplicates_of_odd_rows(clashing, empty):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(clashing).collect()}
    assert found == {(1, 3, 1, True), (None, 0, None, False), (2, 0, 2, True), (2, 3, 1, False)}
    assert near_duplicates(empty).isEmpty()


def test_an_empty_benchmark_contaminates_nothing(table, empty):
    out = decontaminate(table, empty.withColumnRenamed("doc_id", "item_id"))
    assert out.where("n_hit > 0 OR size(items) > 0").isEmpty()
