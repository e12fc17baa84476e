"""Byte-pair encoding and decoding with a public vocabulary file.

Each word is a list of symbols.  A segment tree over its adjacent pairs holds at every
leaf the pair's merge rank and place; the root is the leftmost pair of lowest rank.  A
merge changes three leaves (the pair, its left and its right neighbour) and the nodes
above them, so a word of n symbols takes O(n log n) whatever its length.  The distinct
short words of a chunk are merged side by side, one tree per row of a matrix; a long word
has a tree of its own.

Nulls are empty texts, which encode to no ids and decode to the empty string.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored

# Fixed values of the vocabulary file's normaliser and word pattern.
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_SIDE_BY_SIDE = 64  # symbols of the longest word merged in a matrix
_MEMO_WORDS = 600_000  # words remembered by a task, then forgotten all at once
# White space to Python only; the vocabulary file takes them for symbols.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_CHUNK_CHARS = 2 << 20
_NONE = np.int64(1) << 62


class Vocabulary:
    """Symbols, merges and special tokens of a vocabulary file."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        ids: dict[str, int] = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.specials.values()]) + 1)
        for token, i in [*ids.items(), *self.specials.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([ids[c] for c in letters], np.int64)
        self.last = np.array([ids[c + suffix] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.size = len(self.tokens)
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        either = "|".join(map(regex.escape, self.specials))
        self.special = regex.compile(f"({either})") if either else None

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, ``_NONE`` where they do not merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def merge_long(vocab: Vocabulary, symbols: list[int]) -> list[int]:
    """Merge one word with a tree of its own."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    none, rank_of, width = int(_NONE), vocab.rank_of, vocab.size
    tree = [none] * (2 * size)

    def key(i: int, j: int) -> int:
        rank = rank_of.get(symbols[i] * width + symbols[j])
        return none if rank is None else rank * size + i

    for i in range(n - 1):
        tree[size + i] = key(i, i + 1)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = size + i
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                return
            tree[node] = least

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merged = vocab.merged
    while tree[1] < none:
        rank, i = divmod(tree[1], size)
        gone = after[i]
        symbols[i], symbols[gone] = int(merged[rank]), -1
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
            put(gone, none)
            put(i, key(i, after[i]))
        else:
            if gone < n - 1:
                put(gone, none)
            put(i, none)
        if before[i] >= 0:
            put(before[i], key(before[i], i))
    return [s for s in symbols if s >= 0]


def merge_rows(vocab: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Merge many words at once; ``symbols`` is padded with -1 on the right, as is the result."""
    rows, columns = symbols.shape
    size = 1
    while size < columns - 1:
        size *= 2
    tree = np.full((rows, 2 * size), _NONE, np.int64)
    place = np.arange(columns - 1)
    ranks = vocab.lookup(symbols[:, :-1], symbols[:, 1:])
    ranks = np.where(place[None, :] + 1 < lengths[:, None], ranks, _NONE)
    tree[:, size : size + columns - 1] = np.where(ranks < _NONE, ranks * size + place[None, :], _NONE)
    level = size
    while level > 1:
        level //= 2
        children = tree[:, 2 * level : 4 * level]
        tree[:, level : 2 * level] = np.minimum(children[:, ::2], children[:, 1::2])
    after = np.broadcast_to(np.arange(1, columns + 1), symbols.shape).copy()
    before = np.broadcast_to(np.arange(-1, columns - 1), symbols.shape).copy()
    flat, width = tree.reshape(-1), 2 * size

    def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        base, node = row * width, size + leaf
        flat[base + node] = value
        while node.size and node[0] > 1:
            node = node >> 1
            flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

    active = np.flatnonzero(tree[:, 1] < _NONE)
    while active.size:
        root = tree[active, 1]
        rank, i = root // size, root % size
        gone = after[active, i]
        new = vocab.merged[rank]
        symbols[active, i] = new
        symbols[active, gone] = -1
        nxt = after[active, gone]
        after[active, i] = nxt
        more = nxt < lengths[active]
        before[active[more], nxt[more]] = i[more]
        inner = gone < size
        put(active[inner], gone[inner], np.full(int(inner.sum()), _NONE))
        value = np.full(len(active), _NONE)
        r = vocab.lookup(new[more], symbols[active[more], nxt[more]])
        value[more] = np.where(r < _NONE, r * size + i[more], _NONE)
        put(active, i, value)
        prev = before[active, i]
        has = prev >= 0
        r = vocab.lookup(symbols[active[has], prev[has]], new[has])
        put(active[has], prev[has], np.where(r < _NONE, r * size + prev[has], _NONE))
        active = active[tree[active, 1] < _NONE]
    return symbols


class Encoder:
    """Encodes texts; remembers the ids of words and of runs between white space."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.pattern = regex.compile(_WORD.replace(r"\s", _SPACE))
        self.lines = regex.compile("\n|" + self.pattern.pattern)
        self.memo: dict[str, bytes] = {"\n": b""}
        self.runs: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """The normalised runs of a text without special tokens: no word crosses white space."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # the vocabulary lower-cases letter by letter: no final sigma
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return self.pattern.findall(text) if _SEPARATORS.search(text) else text.split()

    def meet(self, unknown: set[str]) -> None:
        """Encode runs not met before."""
        runs = list(unknown)
        # one search over all of them: a line feed is no part of any word
        found = self.lines.findall("\n".join(runs) + "\n")
        self.learn(set(found).difference(self.memo))
        known, at = self.memo, 0
        for run in runs:
            end = found.index("\n", at)
            self.runs[run] = known[found[at]] if end == at + 1 else b"".join([known[w] for w in found[at:end]])
            at = end + 1

    def learn(self, unknown: Iterable[str]) -> None:
        """Merge words not met before."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in unknown:
            raw = word.encode("utf-8", "surrogatepass")
            n = len(raw)
            if n > _SIDE_BY_SIDE:
                ids = self.vocab.inner[np.frombuffer(raw, np.uint8)]
                ids[-1] = self.vocab.last[raw[-1]]
                self.memo[word] = np.array(merge_long(self.vocab, ids.tolist()), "<u4").tobytes()
            else:
                by_size.setdefault(max(2, 1 << (n - 1).bit_length()), []).append((word, raw))
        for columns, entries in by_size.items():
            for at in range(0, len(entries), 50_000):
                part = entries[at : at + 50_000]
                lengths = np.fromiter((len(raw) for _, raw in part), np.int64, len(part))
                padded = np.frombuffer(b"".join(raw.ljust(columns, b"\0") for _, raw in part), np.uint8)
                padded = padded.reshape(len(part), columns)
                symbols = self.vocab.inner[padded]
                row = np.arange(len(part))
                symbols[row, lengths - 1] = self.vocab.last[padded[row, lengths - 1]]
                symbols[np.arange(columns)[None, :] >= lengths[:, None]] = -1
                merge_rows(self.vocab, symbols, lengths)
                kept = symbols >= 0
                flat = symbols[kept].astype("<u4").tobytes()
                ends = np.cumsum(kept.sum(axis=1)) * 4
                start = 0
                for (word, _), end in zip(part, ends.tolist()):
                    self.memo[word] = flat[start:end]
                    start = end

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        at = 0
        while at < len(texts):
            upto, chars = at, 0
            while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= _CHUNK_CHARS):
                chars += len(texts[upto])
                upto += 1
            # each text: runs, or special tokens between lists of runs
            pieces: list[list[list[str] | str]] = []
            for text in texts[at:upto]:
                special = self.vocab.special
                parts = special.split(text) if special is not None and special.search(text) else [text]
                pieces.append([p if k % 2 else self.split(p) for k, p in enumerate(parts)])
            if len(self.memo) > _MEMO_WORDS or len(self.runs) > _MEMO_WORDS:
                self.memo = {"\n": b""}
                self.runs.clear()
            seen: set[str] = set()
            for piece in pieces:
                seen.update(*piece[::2])
            self.meet(seen.difference(self.runs))
            known = self.runs.__getitem__
            for piece in pieces:
                yield b"".join(
                    np.array([self.vocab.specials[part]], "<u4").tobytes() if k % 2 else b"".join(map(known, part))
                    for k, part in enumerate(piece)
                )
            at = upto

    def decode(self, ids: bytes) -> str:
        """Tokens joined by one space, the file having no decoder of its own."""
        return " ".join(map(self.vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _encoder(text: str) -> Encoder:
    return Encoder(Vocabulary(text))


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", **outputs: str) -> DataFrame:
    """Add ids and their decoded text to every row.

    ``vocabulary`` is the content of the vocabulary file (about 2 MB, read by the caller and
    sent with the task).  ``outputs`` names the added columns: ``ids`` (binary, 32-bit
    little-endian), ``n_tokens``, ``ids_sha256``, ``decoded``, ``decoded_sha256``; a column of
    that name in ``docs`` is replaced.  No shuffle: each row is encoded where it is read.
    """
    if not outputs:
        outputs = {k: k for k in ("n_tokens", "ids_sha256", "decoded_sha256")}
    types = {
        "ids": "binary",
        "n_tokens": "long",
        "ids_sha256": "string",
        "decoded": "string",
        "decoded_sha256": "string",
    }
    unknown = set(outputs) - set(types)
    if unknown:
        raise ValueError(f"no such output: {sorted(unknown)}")
    source, inner, kept = carried(docs, text_col, outputs.values())
    schema = source.select(*inner).schema
    for kind in outputs:
        schema = schema.add(kind, types[kind])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            values = batch.column(batch.num_columns - 1)
            made: dict[str, list] = {kind: [] for kind in outputs}
            texts = [v or "" for v in values.to_pylist()]
            for ids in encoder.encode(texts):
                if "ids" in made:
                    made["ids"].append(ids)
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids) // 4)
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    decoded = encoder.decode(ids)
                    if "decoded" in made:
                        made["decoded"].append(decoded)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            arrow = {"ids": pa.binary(), "n_tokens": pa.int64()}
            columns = [pa.array(made[k], arrow.get(k, pa.string())) for k in outputs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], names=[*inner, *outputs]
            )

    out = source.mapInArrow(work, schema)
    return out.select(*restored(inner, kept), *[F.col(kind).alias(name) for kind, name in outputs.items()])
