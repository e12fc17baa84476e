"""The registered query of each operator and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import compression, licences, line_crf, ngram_lm, secrets, toxicity, whitening
from tallyweave.llm.bpe import encode_documents
from tallyweave.llm.decontaminate import decontaminate
from tallyweave.llm.near_dups import near_duplicates
from tallyweave.llm.squares import periodic_runs
from tallyweave.llm.substrings import remove_repeats
from tallyweave.llm.suffixes import remove_repeated_bytes
from tallyweave.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The content of an installed public vocabulary file."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


@query("op1_substrings")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return remove_repeats(docs, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode_documents(docs, vocabulary()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op3_suffixes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return remove_repeated_bytes(docs, with_text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = line_crf.train(docs, labels(spark, sf_dir).withColumnRenamed("quality", "label"))
    return line_crf.judge(docs, model).drop("text")


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _secrets_sql() -> str:
    parts, order = [], 0
    for order, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""SELECT text, {order} AS ord, '{rule.kind}' AS kind, {rule.least} AS least,
            string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS hits,
            regexp_extract_all(text, '{pattern}', {rule.group}) AS groups
          FROM blobs WHERE regexp_matches(text, '{pattern}')""")
    return f"""WITH blobs AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    each AS (SELECT text, ord, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, groups FROM found),
    placed AS (SELECT text, ord, kind, length(groups[i]) >= least AS ok, length(hits[i]) AS n,
        sum(length(gaps[i]) + length(hits[i])) OVER (PARTITION BY text, ord ORDER BY i) AS stop FROM each),
    spans AS (SELECT text, ord, kind, CAST(stop - n AS BIGINT) AS start,
        kind || ':' || CAST(stop - n AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM placed WHERE ok),
    per_text AS (SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (ord < {len(secrets.BASE)}), '') AS base,
        string_agg(span, ',' ORDER BY start, ord) AS spans FROM spans GROUP BY text)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN per_text p ON p.text = coalesce(d.text, '')"""


@query("op6_secrets", _secrets_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger grows in two steps: texts of some sources, then all texts, of which only unseen ones are scanned."""
    rows, path = documents(spark, sf_dir), shared_folder(spark, "secret-ledger")
    docs = rows.select("doc_id", "text")
    ledger = secrets.extend_ledger(rows.where(F.crc32(F.col("source").cast("binary")) % 2 == 0), path)
    ledger = secrets.extend_ledger(docs, path, ledger)
    found = secrets.findings(docs, ledger)
    base = F.filter("spans", lambda s: s["ord"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), rule.kind).alias(f"n_{rule.kind}") for rule in secrets.BASE],
        F.sha2(secrets.spelled(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


@query("op7_minhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def _licences_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    words = "lower(coalesce(text, ''))"
    for pattern, put in licences.STEPS:
        words = f"regexp_replace({words}, {quoted(pattern)}, {quoted(put)}, 'g')"
    known = " ".join(f"WHEN {quoted(s)} THEN '{i}'" for s, i in licences.sentence_ids().items())
    patterns = dict(licences.rule_patterns())
    found = {n: "(" + " OR ".join(f"line LIKE '{p}'" for p in own) + ")" for n, own in patterns.items()}
    named = ", ".join(
        f"CASE WHEN {' AND NOT '.join([found[n], *[found[f] for f in licences.FULLER.get(n, ())]])} THEN '{n}' END" for n in found
    )
    return f"""WITH spaced AS (SELECT doc_id, ' ' || trim({words}, ' ') || ' ' AS words FROM documents),
    cut AS (SELECT doc_id, len(list_filter(string_split(words, chr(1)), lambda s: trim(s, ' ') <> '')) AS n,
      list_transform(regexp_extract_all(words, {quoted(licences.known_pattern())}, 0), lambda s: CASE s {known} END) AS ids FROM spaced),
    lines AS (SELECT *, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS line FROM cut)
    SELECT doc_id, CAST(n AS BIGINT) AS n_sentences, CAST(len(ids) AS BIGINT) AS n_known, array_to_string(ids, ',') AS sentence_ids,
      array_to_string(list_sort(list_filter([{named}], lambda x: x IS NOT NULL)), ',') AS licences
    FROM lines"""


@query("op8_licences", _licences_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licences.scan_licences(docs).drop("text")


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


@query("op9_compression")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    learned = labels(spark, sf_dir).where(~held_out()).withColumnRenamed("quality", "label")
    model = compression.fit(docs, learned)
    scored = compression.score_documents(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_cross_entropy")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: texts labelled good and not toxic; background: all texts.

    Labels grow with the documents, so their join is a shuffle at every size.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    marks = labels(spark, sf_dir).groupBy("doc_id").agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("good"))
    target = docs.join(marks.where("good").hint("merge"), "doc_id", "left_semi")
    return ngram_lm.score_documents(docs, target).drop("text")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` where each tenth text, by a hash of its id, ends in repetitions of some of its words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    g, n, a = (F.col(c) for c in ("g", "n", "a"))
    cut = cut.withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("words").cast("long")})
    cut = cut.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)))
    period = F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    tail = F.flatten(F.array_repeat(period, F.ceil((n - a) / F.col("p")).cast("int")))
    whole = F.concat(
        F.slice("words", F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int"))
    )
    text = F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"))


@query("op11_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = planted(documents(spark, sf_dir).select("doc_id", "text"))
    found = periodic_runs(docs, with_text=False)
    best = F.col("greatest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


@query("op12_toxicity")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    learned = labels(spark, sf_dir).where(fold != 0).withColumnRenamed("toxic", "label")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, learned))
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long, as from some 10^8 vectors on, is null; ``whiten`` itself has it as a decimal."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = whitening.whiten(vectors, whitening.fit(vectors))
    return found.select(
        "vec_id",
        "component",
        "n",
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )
