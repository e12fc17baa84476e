"""JSON documents to (property, value) rows.

Everything stays in the JVM and in one narrow stage: a document is parsed once to a
variant and opened level by level.  The first levels are generator steps; what is
nested deeper is opened row by row with higher-order functions, so no depth is cut
off and ordinary documents never pay for it.  The same plan runs on a stream.

The expressions are written as SQL text: lambdas nest more readably there, and a
text is parsed by the JVM in one go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAST_LEVELS = 4
_LIST_TEXT_LEVELS = 1
_LONG_DIGITS = 18
BACKSLASH = r"\\"


def _is_object(v: str) -> str:
    """A cast to a struct without fields succeeds for objects only and reads no value."""
    return f"(try_cast({v} AS struct<>) IS NOT NULL)"


def _is_container(v: str) -> str:
    """Objects, and arrays whose first element is an object, are opened."""
    return f"({_is_object(v)} OR try_variant_get({v}, '$[0]', 'struct<>') IS NOT NULL)"


def _scalar_text(v: str, kind: str) -> str:
    """Numbers keep their digits: whole ones written with a fraction (``1.0``) are decimals without a scale,
    which integers of up to ``_LONG_DIGITS`` digits never are."""
    text = f"CAST({v} AS string)"
    whole = f"{kind} LIKE 'DECIMAL%,0)' AND length(replace({text}, '-', '')) <= {_LONG_DIGITS}"
    return f"CASE WHEN {whole} THEN concat({text}, '.0') ELSE {text} END"


def _value_text(v: str, kind: str, level: int = 0) -> str:
    """Text of a value that is not opened: lists as ``[a, b]``, objects as ``{k=v}``, null as ``null``.

    ``kind`` is the value's ``schema_of_variant``.  Fractions are printed with their digits
    (``1.0``, ``2.5``, ``12345678.5``), without zeros at their end.  The outermost lists are written in place, whatever
    they hold is written piece by piece, at any depth and in the same format.
    """
    if level < _LIST_TEXT_LEVELS:
        e = f"e{level}"
        element = _value_text(e, f"schema_of_variant({e})", level + 1)
        nested = f"""CASE WHEN {kind} LIKE 'ARRAY%' THEN
              concat('[', array_join(transform(try_cast({v} AS array<variant>), {e} -> {element}), ', '), ']')
            WHEN {kind} LIKE 'OBJECT%' THEN {_deep_text(v)} ELSE {_scalar_text(v, kind)} END"""
    else:
        nested = f"""CASE WHEN {kind} LIKE 'ARRAY%' OR {kind} LIKE 'OBJECT%' THEN {_deep_text(v)}
            ELSE {_scalar_text(v, kind)} END"""
    return f"coalesce({nested}, 'null')"


def _piece(text: str) -> str:
    return _node(text, "CAST(NULL AS variant)", "false")


def _held(v: str) -> str:
    kind = f"schema_of_variant({v})"
    return _node("CAST(NULL AS string)", v, f"coalesce({kind} LIKE 'ARRAY%' OR {kind} LIKE 'OBJECT%', false)")


def _deep_text(v: str) -> str:
    """A container is replaced by its pieces until only pieces and scalars are left; a piece has its text as path."""
    comma = "CASE WHEN i > 0 THEN ', ' ELSE '' END"
    pieces = f"""coalesce(
        concat(array({_piece("'{'")}), flatten(transform(map_entries(try_cast(n.v AS map<string,variant>)),
          (e, i) -> array({_piece(f"concat({comma}, e.key, '=')")}, {_held("e.value")}))), array({_piece("'}'")})),
        concat(array({_piece("'['")}), flatten(transform(try_cast(n.v AS array<variant>),
          (e, i) -> array({_piece(comma)}, {_held("e")}))), array({_piece("']'")})))"""
    text = f"to_json({v})"
    opened = _open_all(f"array({_held(v)})", _depth(text), pieces)
    scalar = _scalar_text("x.v", "schema_of_variant(x.v)")
    return f"array_join(transform({opened}, x -> coalesce(x.path, {scalar}, 'null')), '')"


def value_text(v: str, kind: str) -> Column:
    return F.expr(_value_text(v, kind))


def _child_path(path: str, name: str) -> str:
    return f"CASE WHEN trim({path}) = '' THEN {name} ELSE concat({path}, '.', {name}) END"


def _node(path: str, v: str, opened: str) -> str:
    return f"named_struct('path', {path}, 'v', {v}, 'open', {opened})"


def _open_all(nodes: str, steps: str, children: str) -> str:
    """Open the nodes level by level, up to ``steps`` levels; ``children`` is the list of the children of ``n``.

    Every level goes over all nodes, so ``steps`` should be no more than the levels there are.
    """
    return f"""aggregate(
        CASE WHEN {steps} > 0 THEN sequence(1, {steps}) ELSE CAST(array() AS array<int>) END,
        {nodes},
        (acc, i) -> CASE WHEN exists(acc, n -> n.open)
            THEN flatten(transform(acc, n -> CASE WHEN n.open THEN {children} ELSE array(n) END)) ELSE acc END)"""


def _count(text: str, char: str) -> str:
    return f"(length({text}) - length(replace({text}, '{char}', '')))"


def _depth(text: str) -> str:
    """How deep brackets are nested in JSON text, those in its strings left out, in one pass over them."""
    brackets = rf"""regexp_replace(regexp_replace({text}, '"(?:[^"\\\\]++|\\\\.)*+"', ''), '[^\\[\\]{{}}]+', '')"""
    return f"""aggregate(split({brackets}, ''), named_struct('at', 0, 'most', 0), (s, c) -> CASE
        WHEN c IN ('[', '{{') THEN named_struct('at', s.at + 1, 'most', greatest(s.most, s.at + 1))
        WHEN c IN (']', '}}') THEN named_struct('at', s.at - 1, 'most', s.most) ELSE s END, s -> s.most)"""


_INDEXED_CHILDREN = f"""coalesce(
    transform(map_entries(try_cast(n.v AS map<string,variant>)),
              e -> {_node(_child_path("n.path", "e.key"), "e.value", _is_container("e.value"))}),
    transform(try_cast(n.v AS array<variant>),
              (e, i) -> {_node(_child_path("n.path", "CAST(i AS string)"), "e", _is_container("e"))}))"""


def _parsed(doc_col: str) -> Column:
    return F.try_parse_json(F.col(doc_col))


def refused_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Documents that are no JSON (cut off, or with a repeated field): flattening leaves them out."""
    return docs.where(F.col(doc_col).isNotNull() & _parsed(doc_col).isNull())


# names of the two counts that ``Observation`` receives
READ, REFUSED = "read", "refused"


def parsed_documents(
    docs: DataFrame, columns: list[str | Column], doc_col: str, counted: Observation | str | None = None
) -> DataFrame:
    """``columns`` and the parsed document ``__v`` of all documents but the refused ones.

    Each document is parsed once.  ``counted`` receives how many documents were read and how many
    of them refused, as they pass: an ``Observation`` in a batch, in a stream a name under which
    each batch's progress holds both.
    """
    some = F.col(doc_col).isNotNull()
    parsed = docs.select(*columns, _parsed(doc_col).alias("__v"), some.alias("__some"))
    refused = F.col("__some") & F.col("__v").isNull()
    counts = [
        F.count(F.lit(1)).alias(READ),
        F.coalesce(F.sum(refused.cast("long")), F.lit(0)).alias(REFUSED),
    ]
    # the counts also keep the condition below from being moved before the parse and parsed once more
    seen = parsed.observe(counted or f"documents-{uuid.uuid4().hex}", *counts)
    return seen.where(~refused).drop("__some")


def flatten_documents(
    docs: DataFrame, key_cols: list[str], doc_col: str = "doc", counted: Observation | str | None = None
) -> DataFrame:
    """(property, value, *key_cols) for every leaf of every document.

    Object keys are joined by ``.``; objects in an array get their index
    (``a.0.b``); an array of plain values is one value.  ``refused_documents`` give no rows;
    ``counted`` learns their number, see ``parsed_documents``.
    """
    tvf = docs.sparkSession.tvf
    nodes = parsed_documents(docs, [*key_cols, F.lit("").alias("__path")], doc_col, counted)
    held = F.expr(f"CASE WHEN {_is_container('__v')} THEN __v END")
    path = F.expr(
        f"CASE WHEN pos IS NULL THEN __path ELSE {_child_path('__path', 'coalesce(key, CAST(pos AS string))')} END"
    ).alias("__path")
    value = F.expr("CASE WHEN pos IS NULL THEN __v ELSE value END").alias("__v")
    keys = [F.col(k) for k in key_cols]
    for _ in range(FAST_LEVELS):
        nodes = nodes.lateralJoin(tvf.variant_explode_outer(held.outer())).select(*keys, path, value)
    still = _is_container("__v")
    text = "to_json(__v)"
    deep = _open_all(f"array({_node('__path', '__v', 'true')})", _depth(text), _INDEXED_CHILDREN)
    # every value passes through the list, so that no row carries the document it was opened from
    value = f"array({_node('__path', '__v', 'false')})"
    spread = nodes.select(*keys, F.explode(F.expr(f"CASE WHEN {still} THEN {deep} ELSE {value} END")).alias("__n"))
    leaves = spread.select(*keys, F.col("__n.path").alias("property"), F.col("__n.v").alias("__v"))
    kinds = leaves.withColumn("__kind", F.schema_of_variant("__v"))
    return kinds.select("property", value_text("__v", "__kind").alias("value"), *keys)


def _embedded(v: str) -> str:
    """A text value that holds a JSON object or array, parsed; anything else as it is."""
    text = f"try_cast({v} AS string)"
    holds = f"({text} RLIKE '^\\\\s*[{{\\\\[]' AND try_cast({v} AS array<variant>) IS NULL)"
    return f"""CASE WHEN {holds} THEN
        coalesce(get(filter(array(try_parse_json({text})), j -> {_is_container('j')}), 0), {v}) ELSE {v} END"""


def _merged_node(path: str, v: str) -> str:
    opened = f"transform(array({_embedded(v)}), w -> {_node(path, 'w', _is_container('w'))})[0]"
    return f"CASE WHEN {_is_object(v)} THEN {_node(path, v, 'true')} ELSE {opened} END"


_MERGED_CHILDREN = f"""coalesce(
    transform(map_entries(try_cast(n.v AS map<string,variant>)),
              e -> {_merged_node(_child_path("n.path", "e.key"), "e.value")}),
    transform(try_cast(n.v AS array<variant>), e -> {_merged_node("n.path", "e")}))"""


def flatten_merge(
    docs: DataFrame, key_cols: list[str], doc_col: str = "doc", counted: Observation | str | None = None
) -> DataFrame:
    """Like ``flatten_documents``, with arrays merged and embedded JSON opened.

    Array elements share one path and the last value of a path wins; text that holds
    JSON is parsed again; nulls stay null.
    """
    near = _open_all(f"array({_node("''", "__v", "true")})", str(FAST_LEVELS), _MERGED_CHILDREN)
    read = parsed_documents(docs, [*key_cols, F.col(doc_col).alias("__doc")], doc_col, counted)
    # levels of the document itself, then those of documents in its strings: each of these has a bracket of
    # its own in the text, or a backslash that hides one
    own = _open_all("__n", f"CASE WHEN exists(__n, x -> x.open) THEN {_depth('__doc')} ELSE 0 END", _MERGED_CHILDREN)
    read = read.select(*key_cols, "__doc", F.explode(F.array(F.expr(near))).alias("__n"))
    opened = read.select(*key_cols, "__doc", F.explode(F.array(F.expr(own))).alias("__n"))
    levels = f"{_count('__doc', '{')} + {_count('__doc', '[')} + {_count('__doc', BACKSLASH)}"
    full = _open_all("__n", f"CASE WHEN exists(__n, x -> x.open) THEN {levels} ELSE 0 END", _MERGED_CHILDREN)
    kinds = f"transform({full}, n -> named_struct('path', n.path, 'v', n.v, 'kind', schema_of_variant(n.v)))"
    ordered = f"""array_sort(transform({kinds}, (n, i) -> named_struct('path', n.path, 'at', i,
        'value', CASE WHEN n.kind <> 'VOID' THEN {_value_text("n.v", "n.kind")} END)))"""
    # the generator keeps the sorted array from being computed once per use below
    rows = opened.select(*key_cols, F.explode(F.array(F.expr(ordered))).alias("__s"))
    last = """filter(zip_with(__s, slice(__s, 2, greatest(size(__s), 1)), (a, b) -> named_struct('row', a, 'next', b)),
        x -> x.next IS NULL OR x.next.path <> x.row.path)"""
    return rows.select(*key_cols, F.explode(F.expr(last)).alias("__x")).select(
        F.col("__x.row.path").alias("property"), F.col("__x.row.value").alias("value"), *key_cols
    )
