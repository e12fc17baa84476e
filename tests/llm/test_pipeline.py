"""The pipeline's stages against brute force over what each was given."""

import os

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyweave.llm.queries import ORACLES, QUERIES, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """What each stage was given and what it returned, as rows by doc_id."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(root, name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return [{r["doc_id"]: r for r in df.collect()} for df in out]


def texts(table):
    return [(d, r["text"]) for d, r in sorted(table.items())]


def test_columns_stay(tables):
    for before, after in zip(tables, tables[1:-1]):
        assert set(next(iter(before.values())).asDict()) == set(next(iter(after.values())).asDict())
        assert set(after) <= set(before)


def test_quality_drops_what_fails_a_base_rule_and_keeps_most(tables):
    failed = {r[0] for r in plain.base_rules(texts(tables[0])) if r[-1]}
    assert not failed & set(tables[1])
    assert len(tables[1]) > 0.7 * (len(tables[0]) - len(failed))


def test_one_of_each_group_stays(tables):
    assert set(tables[2]) == {d for d, _, _, kept in plain.near_duplicates(texts(tables[1]), 5, 80) if kept}


def test_one_row_of_each_group_stays_with_and_without_ids(spark):
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:100], "other", *words[101:]])
    rows = [(1, "one clean text"), (None, "a clean text without an id"), (2, " ".join(words)), (2, near), (None, near)]
    rows += [(None, "all of these rows lack an id")] * 2 + [(None, None), (3, None), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()]
    of_two = [r for r in kept if r[1] in (near, " ".join(words))]
    assert len(of_two) == 1 and of_two[0][0] == 2
    rest = {r for r in rows if r[1] not in (near, " ".join(words))}
    assert sorted(kept, key=repr) == sorted([*rest, *of_two], key=repr)


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    first = [f"w{i}" for i in range(400)]
    longer = first + [f"new{i}" for i in range(82)]  # similarity 0.83
    second = [f"v{i}" for i in range(400)]
    edited = [f"edit{i}" if i % 60 == 20 else w for i, w in enumerate(second)]  # 0.84
    apart = [f"u{i}" for i in range(400)]
    grown = apart + [f"more{i}" for i in range(110)]  # 0.78
    rows = list(enumerate(" ".join(t) for t in (first, longer, second, edited, apart, grown)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0] for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()} == {0, 2, 4, 5}


CLASHES = ("__row", "name", "clean", "spans", "kept", "n_words", "n_hit", "items", "blob", "c0", "id", "content_share")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_tables(spark, name, stage):
    """Null, empty and equal rows, columns under names that stages use themselves, and no rows."""
    text = "a plain line of words that says one thing after the other\nand one more line of words\n"
    other = "quite another text stands here with some words that no other row of this table has in it\n"
    secret = other + "password = abcdefghijklmnop0123"
    rows = [(1, text), (1, text), (None, text), (2, None), (2, None), (None, None), (3, ""), (4, secret)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    docs = docs.withColumns({c: F.lit(c) for c in CLASHES}).repartition(3)
    out = stage(spark, docs, SF_DIR).collect()
    for row in out:
        assert all(row[c] == c for c in CLASHES)
    found = sorted(((r["doc_id"], r["text"]) for r in out), key=repr)
    expected = {
        "quality_rules": [r for r in rows if r[1]],
        "near_dedup": [(1, text), (2, None), (None, None), (3, ""), (4, secret)],
        "secrets": [r if r[0] != 4 else (4, other + "[REDACTED]") for r in rows],
    }.get(name, rows)
    assert found == sorted(expected, key=repr)
    none = stage(spark, docs.limit(0), SF_DIR)
    assert none.collect() == [] and set(docs.columns) <= set(none.columns)


def test_contaminated_documents_go(spark, tables):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert set(tables[3]) == {d for d, _, hit, _ in plain.contamination(texts(tables[2]), items) if not hit}


def test_secrets_are_cut(tables):
    for doc_id, row in tables[4].items():
        before = tables[3][doc_id]["text"]
        assert not plain.secret_spans(row["text"].replace("[REDACTED]", " "))
        if not plain.secret_spans(before):
            assert row["text"] == before
        assert row["n_chars"] == len(row["text"]) or row["text"] == before


def test_the_rest_is_encoded(tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(vocabulary())
    assert set(tables[5]) == set(tables[4])
    for row in tables[5].values():
        assert row["ids"] == np.array(library.encode(row["text"], add_special_tokens=False).ids, "<u4").tobytes()


def test_run_is_all_stages(spark, tables):
    assert {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()} == tables[-1]


def test_every_operator_has_its_query():
    for n in range(1, 14):
        assert any(name.startswith(f"op{n}_") for name in QUERIES)
    assert {"op6_secrets", "op8_licences"} <= set(ORACLES)


@pytest.mark.parametrize("name", ["op6_secrets", "op8_licences"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
