"""Toxicity by a support vector machine with a gap-weighted subsequence kernel.

Text is read as symbols of a small alphabet: letters without case or accents, one class each
for digits and for all separators (runs of them count once), three for other scripts.  The kernel of
two strings compares all subsequences of ``LENGTH`` symbols that span ``SPAN`` symbols at most;
an occurrence weighs ``DECAY`` to the power of the symbols it skips, so a letter put in
or left out, or separators between letters, lower the kernel but do not break it.

A sentence is judged by its windows of ``WINDOW`` consecutive starts of subsequences, a document
by its best window.  The machine is trained on sentences of labelled documents: those of clean
documents are negative; of a toxic one the sentence holding its best window is positive,
found anew each round, while the best windows of clean documents join the negatives.
Landmarks are words whose frequency in toxic documents stands out, the same spelled out with
separators, and frequent words of clean documents; the Nyström map K(., L) K(L, L)^(-1/2) makes the
machine linear.  As the kernel is a sum over subsequences, a trained machine folds into
one weight for each of the 2^20 subsequences: scoring is 20 look-ups for each symbol, exactly
the kernel expansion over the landmarks.  A logistic curve on labelled documents kept from
training, and on copies of some toxic ones with a letter put into their best window, turns a
document's best window into a score.

Training takes a bounded sample (``FitLimits``); scoring reads every row whole where it is, without a
shuffle, some hundred bytes in memory for each character of a chunk or of one longer text.  Nulls
are empty texts; a text without a subsequence has margin 0 and the curve's value there.
Copies of a text count once in training, and one labelled both ways counts as clean.  Labels
without document, or other than 0 and 1, count for nothing.  Without labels of both classes
nothing can be learned and every score is 0.  Equal rows get equal scores, an empty table none.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.compression import fit_logistic
from tallyweave.llm.samples import labelled_sample

LENGTH, SPAN, DECAY = 4, 7, 0.75
WINDOW = 9
BITS = 5  # of a symbol
#: standard errors by which a marking string is more frequent in toxic texts; symbols of the longest beginning
STANDS_OUT, LONGEST = 4.5, 8
#: toxic texts to one disguised copy when the curve is fitted
DISGUISED = 5
#: symbols of a step of scoring
STEP = 1 << 17

_EDGE, _DIGIT, _GAP, _OTHER = 0, 27, 28, 29
_PAD = SPAN + WINDOW


def _alphabet() -> np.ndarray:
    """The symbol of each code point of the basic plane."""
    out = np.full(1 << 16, _GAP, np.int64)
    for point in range(1 << 16):
        base = unicodedata.normalize("NFKD", chr(point))[:1].lower()[:1]
        if "a" <= base <= "z":
            out[point] = ord(base) - 96
        elif base.isdigit():
            out[point] = _DIGIT
        elif base.isalpha():
            out[point] = _OTHER + point % 3
    return out


_SYMBOL = _alphabet()
_SPACE = np.zeros(1 << 16, bool)
_SPACE[[p for p in range(1 << 16) if chr(p).isspace()]] = True
_STOP = np.zeros(1 << 16, bool)
_STOP[[ord(c) for c in ".!?。！？"]] = True
#: offsets of the symbols of a subsequence after its first, and its weight
_PATTERNS = [
    (o, DECAY ** (o[-1] + 1 - LENGTH)) for o in combinations(range(1, SPAN), LENGTH - 1)
]


class Sentences:
    """The sentences of some texts as symbols, ``_PAD`` edges after each; rows[r]:rows[r + 1] is text r."""

    def __init__(self, texts: list[str]) -> None:
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.minimum(points, 0xFFFF)
        symbols = _SYMBOL[low]
        wide = points > 0xFFFF
        symbols[wide] = _OTHER + points[wide] % 3
        ends = points == 10
        ends[1:] |= _STOP[low[:-1]] & _SPACE[low[1:]]
        symbols[ends] = _EDGE
        keep = np.ones(len(points), bool)
        keep[1:] = (symbols[1:] != _GAP) | ((symbols[:-1] != _GAP) & ~ends[:-1])
        kept = np.concatenate([[0], np.cumsum(keep + (_PAD - 1) * ends)])
        place = kept[:-1][keep]
        self.symbols = np.zeros(int(kept[-1]) + _PAD, np.int64)
        self.symbols[place] = symbols[keep]
        self.rows = kept[np.concatenate([[0], np.cumsum(sizes)])]
        self.breaks = kept[:-1][ends]

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The weight of each window, by its start."""
        n = len(self.symbols) - _PAD
        out = np.zeros(n + _PAD)
        for at in range(0, n, STEP):
            part = self.symbols[at : at + STEP + SPAN]
            out[at : at + min(STEP, n - at)] = _start_weights(part, min(STEP, n - at), weights)
        running = np.concatenate([[0.0], np.cumsum(out)])
        return running[WINDOW : n + WINDOW] - running[:n]

    def best(self, weights: np.ndarray) -> np.ndarray:
        """The greatest window of each text, 0 at least: windows at the edges are empty."""
        if len(self.rows) == 1:
            return np.zeros(0)
        return np.maximum(np.maximum.reduceat(self.sums(weights), self.rows[:-1]), 0.0)


def _start_weights(symbols: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(n, np.float64)
    of_span: dict[float, np.ndarray] = {}
    for (one, two, three), weight in _PATTERNS:
        keys = (symbols[:n] << 15) | (symbols[one : one + n] << 10) | (symbols[two : two + n] << 5) | symbols[three : three + n]
        found = weights.take(keys)
        if weight in of_span:
            of_span[weight] += found
        else:
            of_span[weight] = found
    for weight, found in of_span.items():
        total += weight * found
    return total


def features(symbols: np.ndarray, starts: int) -> dict[int, float]:
    """The subsequences that begin at one of the first ``starts`` symbols, and their weights."""
    out: dict[int, float] = {}
    own = symbols.tolist()
    for i in range(min(starts, len(own))):
        for (one, two, three), weight in _PATTERNS:
            if i + three < len(own):
                parts = (own[i], own[i + one], own[i + two], own[i + three])
                if _EDGE not in parts:
                    key = parts[0] << 15 | parts[1] << 10 | parts[2] << 5 | parts[3]
                    out[key] = out.get(key, 0.0) + weight
    return out


def kernel(one: dict[int, float], two: dict[int, float]) -> float:
    """The subsequence kernel of two strings by their features."""
    if len(two) < len(one):
        one, two = two, one
    return sum(w * two[k] for k, w in one.items() if k in two)


@dataclass(frozen=True)
class FitLimits:
    """Bounds of what the driver trains on."""

    #: labelled texts of each class; a third of them is kept for the curve
    texts: int = 900
    #: bytes of the longest text taken; longer ones are left to scoring
    text_bytes: int = 16_384
    #: landmarks of each of the three kinds
    landmarks: int = 160
    #: windows of one toxic text that are positive
    windows: int = 6
    rounds: int = 5


@dataclass(frozen=True)
class ToxicityModel:
    #: of each subsequence
    weights: np.ndarray
    slope: float
    offset: float

    def scores(self, margins: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.zeros(len(margins))
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -40, 40)))


NOTHING = ToxicityModel(np.zeros(1 << BITS * LENGTH, np.float32), 0.0, 0.0)


Symbols = tuple[int, ...]


def _strings(symbols: np.ndarray) -> set[Symbols]:
    """The distinct words of some sentences as symbols between separators, and how they begin."""
    parts = np.where(symbols == _EDGE, _GAP, symbols).astype(np.uint8).tobytes().split(bytes([_GAP]))
    out = set()
    for part in set(parts):
        if LENGTH <= len(part) <= 2 * WINDOW:
            out.add((_GAP, *part, _GAP))
        out.update((_GAP, *part[:n]) for n in range(LENGTH, min(len(part), LONGEST) + 1))
    return out


def landmarks(clean: list[str], toxic: list[str], each: int) -> tuple[list[Symbols], list[Symbols]]:
    """(strings that mark toxic texts, all landmarks: these, these spelled out, and frequent clean words).

    A string marks toxic texts if its share of them exceeds that of clean ones by ``STANDS_OUT``
    standard errors; of strings that begin alike and are about as frequent the first one stays.
    """
    counts = [Counter(w for t in own for w in _strings(Sentences([t]).symbols)) for own in (clean, toxic)]

    def rise(word: Symbols) -> float:
        one, zero = counts[1][word], counts[0][word]
        share = (one + zero + 1) / (len(clean) + len(toxic) + 2)
        spread = share * (1 - share) * (1 / len(toxic) + 1 / len(clean))
        return (one / len(toxic) - zero / len(clean)) / spread**0.5

    ranked = sorted((-rise(w), -len(w), w) for w, n in counts[1].items() if n > 1)
    marked: list[Symbols] = []
    heads: dict[Symbols, list[int]] = {}
    for fall, _, word in ranked:
        if len(marked) == each or (-fall < STANDS_OUT and len(marked) >= 8):
            break
        near = heads.setdefault(word[: LENGTH + 1], [])
        if all(abs(counts[1][word] - n) > 0.2 * n for n in near):
            near.append(counts[1][word])
            marked.append(word)
    spelled = [(_GAP, *(s for a in w if a != _GAP for s in (a, _GAP))) for w in marked]
    common = sorted((w for w in counts[0] if w[-1] == _GAP), key=lambda w: (-counts[0][w], w))[:each]
    return marked, list(dict.fromkeys([*marked, *spelled, *common]))


class Nystroem:
    """The map of windows into the span of the landmarks."""

    def __init__(self, words: list[tuple[int, ...]]) -> None:
        found = [features(np.array(w), len(w)) for w in words]
        keys = sorted({k for f in found for k in f})
        self.keys = np.array(keys, np.int64)
        self.place = {k: i for i, k in enumerate(keys)}
        self.rows = np.zeros((len(words), len(keys)))
        for row, f in zip(self.rows, found):
            for k, w in f.items():
                row[self.place[k]] = w
        self.rows /= np.maximum(np.linalg.norm(self.rows, axis=1, keepdims=True), 1e-12)
        values, turns = np.linalg.eigh(self.rows @ self.rows.T)
        some = values > 1e-6 * values.max()
        self.root = turns[:, some] / np.sqrt(values[some])

    def map(self, windows: list[dict[int, float]]) -> np.ndarray:
        against = np.zeros((len(windows), len(self.rows)))
        for out, window in zip(against, windows):
            own = [(self.place[k], w) for k, w in window.items() if k in self.place]
            if own:
                at, weight = zip(*own)
                out[:] = self.rows[:, list(at)] @ np.array(weight)
        return against @ self.root

    def fold(self, direction: np.ndarray) -> np.ndarray:
        """The weight of every subsequence, for a machine linear in the map."""
        out = np.zeros(1 << BITS * LENGTH, np.float32)
        out[self.keys] = (self.root @ direction) @ self.rows
        return out


def machine(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """A support vector machine with squared hinge loss, both classes weighing the same: (direction, offset)."""
    z = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y == 1, 1.0, -1.0)
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y) * cost
    ridge = np.append(np.ones(x.shape[1]), 1e-6)
    w = np.zeros(z.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(0.5 * (ridge * w * w).sum() + 0.5 * (weight * np.maximum(1 - sign * (z @ w), 0) ** 2).sum())

    now = loss(w)
    for _ in range(rounds):
        slack = 1 - sign * (z @ w)
        live = slack > 0
        gradient = ridge * w - z[live].T @ (weight * sign * slack)[live]
        step = np.linalg.solve(np.diag(ridge) + (z[live] * weight[live, None]).T @ z[live], gradient)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-9 * max(before, 1.0):
            break
    return w[:-1], float(w[-1])


def _variants(window: np.ndarray, draw: np.random.Generator) -> list[np.ndarray]:
    """A window with a letter put in, and spelled out with separators."""
    inner = window[window != _EDGE]
    if len(inner) < 2:
        return []
    at = int(draw.integers(1, len(inner)))
    more = np.insert(inner, at, int(draw.integers(1, 27)))
    letters = inner[inner != _GAP]
    return [more, np.ravel(np.column_stack([letters, np.full(len(letters), _GAP)]))]


def _seeds(sentences: Sentences, marked: list[Symbols]) -> list[list[np.ndarray]]:
    """For each text, its windows that begin with a marking string, the first of each string."""
    raw = np.where(sentences.symbols == _EDGE, _GAP, sentences.symbols).astype(np.uint8).tobytes()
    out = []
    for first, last in zip(sentences.rows[:-1].tolist(), sentences.rows[1:].tolist()):
        own = []
        for word in marked:
            # edges count as separators, so that words at the ends of sentences are found
            at = raw.find(bytes(word), max(first - 1, 0), last)
            if at >= 0:
                own.append(sentences.symbols[at : at + WINDOW + SPAN - 1])
        out.append(own)
    return out


def train(clean: list[str], toxic: list[str], limits: FitLimits) -> np.ndarray:
    """The weights of all subsequences, trained on sentences of labelled texts."""
    marked, words = landmarks(clean, toxic, limits.landmarks)
    if not words:
        return NOTHING.weights
    space = Nystroem(words)
    whole = [Sentences(clean), Sentences(toxic)]
    draw = np.random.default_rng(7)
    positives: dict[bytes, dict[int, float]] = {}
    negatives: dict[bytes, dict[int, float]] = {}

    def add_positive(window: np.ndarray) -> None:
        if window.tobytes() not in positives:
            positives[window.tobytes()] = features(window, WINDOW)
            for variant in _variants(window[:WINDOW], draw):
                positives[variant.tobytes()] = features(variant, len(variant))

    seeds = _seeds(whole[1], marked)
    for own in seeds:
        for window in own[: limits.windows]:
            add_positive(window)
    # to begin with, the sum of the marking strings
    weights = np.zeros(1 << BITS * LENGTH, np.float32)
    weights[space.keys] = space.rows[: len(marked)].sum(axis=0)
    for _ in range(limits.rounds):
        sums = [s.sums(weights) for s in whole]
        found = dict(positives)
        for own, first, last in zip(seeds, whole[1].rows[:-1], whole[1].rows[1:]):
            if not own:
                at = int(first + sums[1][first:last].argmax())
                window = whole[1].symbols[at : at + WINDOW + SPAN - 1]
                found.setdefault(window.tobytes(), features(window, WINDOW))
        # the best window of every clean sentence, the best sentences of all
        edges = np.unique(np.append(whole[0].breaks, whole[0].rows[:-1]))
        edges = edges[edges < len(sums[0])]
        tops = np.maximum.reduceat(sums[0], edges)
        for k in np.argsort(-tops)[: 2 * len(clean)]:
            last = edges[k + 1] if k + 1 < len(edges) else len(sums[0])
            at = int(edges[k] + sums[0][edges[k] : last].argmax())
            window = whole[0].symbols[at : at + WINDOW + SPAN - 1]
            negatives.setdefault(window.tobytes(), features(window, WINDOW))
        mapped = space.map([*negatives.values(), *found.values()])
        y = np.array([0] * len(negatives) + [1] * len(found))
        direction, _ = machine(mapped, y)
        weights = space.fold(direction)
    return weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    limits: FitLimits = FitLimits(),
    key: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
) -> ToxicityModel:
    """Train on a bounded sample of the documents that ``labels`` marks 0 or 1."""
    sample = labelled_sample(docs, labels, limits.texts, limits.text_bytes, key, text_col, label_col)
    return fit_texts(sample[0], sample[1], limits)


def _disguised(sentences: Sentences, weights: np.ndarray) -> np.ndarray:
    """The weight of the best window of every ``DISGUISED``-th text with a letter put in: so much the curve has to allow for."""
    draw = np.random.default_rng(11)
    sums = sentences.sums(weights)
    out = []
    rows = list(zip(sentences.rows[:-1].tolist(), sentences.rows[1:].tolist()))
    for first, last in rows[::DISGUISED]:
        at = first + int(sums[first:last].argmax())
        for variant in _variants(sentences.symbols[at : at + WINDOW], draw)[:1]:
            out.append(sum(w * float(weights[k]) for k, w in features(variant, WINDOW).items()))
    return np.array(out)


def fit_texts(clean: list[str], toxic: list[str], limits: FitLimits = FitLimits()) -> ToxicityModel:
    if not clean or not toxic:
        return NOTHING
    taken, rest = [], []
    for texts in (clean, toxic):
        own = [t for i, t in enumerate(texts) if i % 3 != 2]
        taken.append(own)
        rest.append(texts[2::3] or own)
    weights = train(*taken, limits)
    if not weights.any():
        return NOTHING
    low, high = (Sentences(texts) for texts in rest)
    margins = [low.best(weights), high.best(weights), _disguised(high, weights)]
    y = np.repeat([0.0, 1.0, 1.0], [len(m) for m in margins])
    slope, offset = fit_logistic(np.concatenate(margins)[:, None], y)
    return ToxicityModel(weights, slope, offset)


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score per row; a column of that name is replaced."""
    source, inner, kept = carried(docs, text_col, [name])
    schema = source.select(*inner).schema.add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            scores = [fitted.scores(s.best(fitted.weights)) for s in _chunks(batch.columns[-1])]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*inner, "score"])

    return source.mapInArrow(work, schema).select(*restored(inner, kept), F.col("score").alias(name))


def _chunks(column: pa.Array) -> Iterator[Sentences]:
    texts: list[str] = []
    size = 0
    for value in column:
        text = value.as_py() or ""
        if texts and size + len(text) > STEP:
            yield Sentences(texts)
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield Sentences(texts)
