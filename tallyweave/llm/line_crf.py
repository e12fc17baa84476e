"""Quality rules: base counts of a text, and a linear-chain CRF over its lines.

Each line with a word is described by binary features (length, symbols, capitals, table
bars, repeated words, how it begins and ends ...).  A conditional random field over the
sequence of lines, trained by maximum likelihood, labels every line as content or
boilerplate; Viterbi decoding gives the best sequence.  A text is kept when at least
``share`` of its words stand in content lines and no base rule fails.

Training takes a bounded sample of labelled texts (``CrfLimits``): all lines of a good text
count as content, all lines of a bad one as boilerplate.  Scoring needs no shuffle.

Nulls are empty texts: no words, so the base rules fail and they are not kept.  Without
labels of both classes every line is content and the base rules alone decide.  Equal rows are
judged alike, each in a row of its own; of two label sequences equally likely the one that keeps
more is taken, and a share of exactly ``share`` is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.samples import labelled_sample
from tallyweave.llm.words import (
    U64,
    Words,
    byte_prefix,
    chunks,
    covered,
    mix,
    range_hash,
    table,
    texts,
    window_hash,
)

# Fixed values of the base rules.
SYMBOLS = table(b"#*$%&|<>")
REPEAT_WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent

_UPPER, _LETTER, _DIGIT = (table(bytes(range(a, b))) for a, b in ((65, 91), (97, 123), (48, 58)))
_LETTER |= _UPPER | table(bytes(range(128, 256)))
_BAR, _BANG = table(b"|"), table(b"!")
_STOP = table(b".!?:;\"')")
_INNER = ~table(bytes(range(128, 192)))  # first bytes of code points


@dataclass(frozen=True)
class CrfLimits:
    """Bounds of the training sample and of the training."""

    texts: int = 800
    text_bytes: int = 16_384
    #: lines of the longest text trained on
    lines: int = 400
    rounds: int = 250


@dataclass(frozen=True)
class Crf:
    """Weights of the content label against boilerplate; ``moves[a][b]`` of label b after a."""

    emit: tuple[float, ...]
    moves: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best label of each line; rows first[r]:first[r + 1] are one text."""
        scores = (features @ np.array(self.emit)).tolist()
        (m00, m01), (m10, m11) = self.moves
        labels = np.ones(len(scores), np.int8)
        for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
            if start == end:
                continue
            v0, v1 = 0.0, scores[start]
            back: list[tuple[int, int]] = []
            for score in scores[start + 1 : end]:
                from0, from1 = (0, v0 + m00) if v0 + m00 > v1 + m10 else (1, v1 + m10), (
                    (0, v0 + m01) if v0 + m01 > v1 + m11 else (1, v1 + m11)
                )
                back.append((from0[0], from1[0]))
                v0, v1 = from0[1], from1[1] + score
            label = 1 if v1 >= v0 else 0  # a tie keeps the line
            labels[end - 1] = label
            for at in range(end - 2, start - 1, -1):
                label = back[at - start][label]
                labels[at] = label
        return labels


ALL_CONTENT = Crf((), ((0.0, 0.0), (0.0, 0.0)))


class Page:
    """Counts and line features of the texts of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        words = Words(data, offsets)
        counts, first = words.counts(), words.first
        n = len(words.start)
        row = np.repeat(np.arange(len(counts)), counts)
        self.n_words = counts
        heads = _running(_INNER[data])
        per_word = heads[words.end] - heads[words.start]
        self.word_chars = _sums(per_word, first)
        self.n_symbols = _sums(SYMBOLS[data], offsets)
        self.repeated = self._repeats(words, row, n)
        self.n_repeat_words = _sums(self.repeated, first)
        self._lines(data, offsets, words)

    @staticmethod
    def _repeats(words: Words, row: np.ndarray, n: int) -> np.ndarray:
        """Flags of the words in windows that occur twice or more in their text."""
        starts = np.flatnonzero(words.starts(REPEAT_WINDOW))
        if not len(starts):
            return np.zeros(n, bool)
        keys = window_hash(words.hashes(), REPEAT_WINDOW)[starts] + mix(row[starts].astype(U64) + U64(1))
        _, where, times = np.unique(keys, return_inverse=True, return_counts=True)
        return covered(starts[times[where] > 1], REPEAT_WINDOW, n)

    def _lines(self, data: np.ndarray, offsets: np.ndarray, words: Words) -> None:
        breaks = np.flatnonzero(data == 10)
        start = np.concatenate([offsets[:-1], breaks + 1])
        start.sort()
        # a text's last line ends with the text, any other one before its line feed
        end = np.append(start[1:], len(data))
        row = np.searchsorted(offsets, start, side="right") - 1
        # rows of empty texts share an offset: keep the line with the last of them
        fed = np.zeros(len(data) + 1, bool)
        fed[breaks + 1] = True
        end = end - (fed[end] & (end > start))
        first_word = np.searchsorted(words.start, start)
        last_word = np.searchsorted(words.start, end)
        some = last_word > first_word
        start, end, row = start[some], end[some], row[some]
        first_word, last_word = first_word[some], last_word[some]
        counts = last_word - first_word
        self.line_words, self.line_row = counts, row
        self.line_first = np.searchsorted(row, np.arange(len(offsets)))
        prefix = byte_prefix(data)
        keys = range_hash(prefix, start, end) + mix(row.astype(U64) + U64(1))
        again = np.ones(len(keys), bool)
        again[np.unique(keys, return_index=True)[1]] = False
        self.n_dup_lines = np.bincount(row[again], minlength=len(offsets) - 1)
        size = np.maximum(end - start, 1)
        share = {}
        kinds = {"symbol": SYMBOLS, "bar": _BAR, "bang": _BANG, "digit": _DIGIT, "upper": _UPPER, "letter": _LETTER}
        for name, kind in kinds.items():
            running = _running(kind[data])
            share[name] = running[end] - running[start]
        repeated = _running(self.repeated)
        rep = (repeated[last_word] - repeated[first_word]) / counts
        head, tail = data[words.start[first_word]], data[words.end[last_word - 1] - 1]
        symbol, bar, bang = share["symbol"] / counts, share["bar"] / counts, share["bang"] / counts
        letters = share["letter"] / size
        upper = share["upper"] / np.maximum(share["letter"], 1)
        width = (end - start) / counts
        marks = [
            np.ones(len(counts), bool),
            counts <= 2,
            (counts > 2) & (counts <= 6),
            counts > 40,
            (symbol > 0) & (symbol <= 0.2),
            (symbol > 0.2) & (symbol <= 1),
            symbol > 1,
            bar > 0.1,
            bar > 0.4,
            bang > 0.3,
            upper > 0.3,
            upper > 0.8,
            share["digit"] / size > 0.2,
            letters < 0.6,
            rep > 0,
            rep > 0.5,
            again,
            _STOP[tail],
            _UPPER[head] | (head >= 128),
            width > 14,
            width < 3.5,
        ]
        self.features = np.column_stack(marks).astype(np.float64)


def _running(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    running = _running(values)
    return running[first[1:]] - running[first[:-1]]


def train(
    docs: DataFrame, labels: DataFrame, limits: CrfLimits = CrfLimits(), key: str = "doc_id", text_col: str = "text",
    label_col: str = "label",
) -> Crf:
    """Fit on a bounded sample of labelled texts."""
    sample = labelled_sample(docs, labels, limits.texts, limits.text_bytes, key, text_col, label_col)
    if not sample[0] or not sample[1]:
        return ALL_CONTENT
    raw = [(t.encode(), label) for label in (0, 1) for t in sample[label]]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in raw])])
    page = Page(np.frombuffer(b"".join(t for t, _ in raw), np.uint8), offsets)
    short = np.flatnonzero((np.diff(page.line_first) > 0) & (np.diff(page.line_first) <= limits.lines))
    labels_ = np.array([label for _, label in raw])[short]
    if len(set(labels_.tolist())) < 2:
        return ALL_CONTENT
    return fit(page.features, page.line_first, short, labels_, limits.rounds)


def fit(
    features: np.ndarray,
    first: np.ndarray,
    rows: np.ndarray,
    labels: np.ndarray,
    rounds: int,
    rate: float = 0.1,
    ridge: float = 1e-3,
) -> Crf:
    """Maximum likelihood by gradient ascent; forward and backward sums run over all texts at once.

    ``rows`` are the texts trained on, none without lines.  Each text weighs the same and both
    classes weigh the same.
    """
    sizes, starts = np.diff(first)[rows], first[:-1][rows]
    texts_, longest, k = len(sizes), int(sizes.max()), features.shape[1]
    order = np.argsort(-sizes)
    sizes, starts, labels = sizes[order], starts[order], labels[order]
    at = starts[:, None] + np.minimum(np.arange(longest)[None, :], sizes[:, None] - 1)
    valid = np.arange(longest)[None, :] < sizes[:, None]
    gold = labels[:, None] * np.ones((1, longest))
    weight = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1)) / sizes
    w, moves = np.zeros(k), np.zeros((2, 2))
    m1, m2 = np.zeros(k + 4), np.zeros(k + 4)
    pairs = valid[:, 1:]
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (pairs.sum(axis=1) * weight)[labels == label].sum()
    for step in range(1, rounds + 1):
        score = (features @ w)[at]
        forward = np.zeros((longest, texts_, 2))
        backward = np.zeros((longest, texts_, 2))
        forward[0, :, 1] = score[:, 0]
        for t in range(1, longest):
            live = int((sizes > t).sum())
            f = forward[t - 1, :live, :, None] + moves[None]
            forward[t, :live] = np.logaddexp(f[:, 0], f[:, 1])
            forward[t, :live, 1] += score[:live, t]
        for t in range(longest - 2, -1, -1):
            live = int((sizes > t + 1).sum())
            ahead = backward[t + 1, :live].copy()
            ahead[:, 1] += score[:live, t + 1]
            b = moves[None] + ahead[:, None, :]
            backward[t, :live] = np.logaddexp(b[..., 0], b[..., 1])
        total = np.logaddexp(*(forward[sizes - 1, np.arange(texts_)].T))
        p1 = np.exp(np.clip(forward[..., 1].T + backward[..., 1].T - total[:, None], -50, 0))
        push = np.where(valid, gold - p1, 0.0) * weight[:, None]
        g = np.zeros(k + 4)
        np.add.at(line_push := np.zeros(len(features)), at[valid], push[valid])
        g[:k] = features.T @ line_push - ridge * w
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                joint = forward[:-1, :, a].T + moves[a, b] + backward[1:, :, b].T - total[:, None]
                if b:
                    joint = joint + score[:, 1:]
                expected[a, b] = (np.where(pairs, np.exp(np.clip(joint, -50, 0)), 0.0) * weight[:, None]).sum()
        g[k:] = (seen - expected).ravel() - ridge * moves.ravel()
        m1 = 0.9 * m1 + 0.1 * g
        m2 = 0.999 * m2 + 0.001 * g * g
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, moves = w + move[:k], moves + move[k:].reshape(2, 2)
    return Crf(tuple(w.tolist()), tuple(map(tuple, moves.tolist())))


NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"
)


def judge(docs: DataFrame, model: Crf, share: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``content_share`` and ``kept``; columns of those names are replaced."""
    source, inner, kept = carried(docs, text_col, NAMES)
    schema = source.select(*inner).schema
    for name in NAMES[:5]:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("content_share", "double").add("kept", "boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.columns[-1])
            made: list[list[np.ndarray]] = [[] for _ in NAMES]
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                for column, values in zip(made, measure(data[offsets[first] : offsets[last]], own, model, share)):
                    column.append(values)
            columns = [
                pa.array(np.concatenate(c) if c else np.zeros(0)).cast(t)
                for c, t in zip(made, [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()])
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*inner, *NAMES])

    return source.mapInArrow(work, schema).select(*restored(inner, kept), *NAMES)


def measure(data: np.ndarray, offsets: np.ndarray, model: Crf, share: float) -> list[np.ndarray]:
    """The values of ``NAMES`` for the texts of a chunk."""
    page = Page(data, offsets)
    n = page.n_words
    failed = (n < LEAST_WORDS) | (100 * page.n_repeat_words > MOST_REPEATED * n)
    if model.emit:
        labels = model.decode(page.features, page.line_first)
    else:
        labels = np.ones(len(page.line_words), np.int8)
    inside = np.bincount(page.line_row, page.line_words * labels, len(n))
    part = np.where(n > 0, inside / np.maximum(n, 1), 0.0)
    counts = [n, page.word_chars, page.n_symbols, page.n_dup_lines, page.n_repeat_words]
    return [c.astype(np.int64) for c in counts] + [failed, part, ~failed & (part >= share)]
