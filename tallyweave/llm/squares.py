"""Periodic runs of words, found by online square catching.

A *square* is a stretch of words followed at once by itself; a *run* is a maximal stretch whose
words repeat at distance q, its smallest period.  Words are appended one after another.
Every block of s = 2^(k-1) words that has been completed (blocks are aligned within
their text; for k = 0 a block is one word) gets a *catcher* for periods from 2^k to 2^(k+1) - 1.
The first half of a square of such a period holds a whole block, so the block comes again one
period later: each appended word advances the comparison of the suffix of s words that
it ends with the blocks of the catchers alive at that distance, two on each level, and an
equal pair is a catch.  Catches of neighbouring blocks at one distance are squares of one run:
they merge, and the two ends, each less than a block away, are found by binary search over
prefix hashes.  A run's multiples of its period give the same stretch, and the least one stays.

A text of n words takes O(n log n) comparisons.  The words of many texts are
appended together (``Catchers.append`` takes any number of words, and the result does not
depend on how they are dealt), one numpy step a level; a task holds some hundred bytes for
each word of a chunk of ``CHUNK_BYTES`` or of one longer text.  Equality rests on 64-bit hashes
during the search only: equal words never miss each other, and ``find_runs`` compares the
words of every reported run, searching a text anew without hashes should they differ.

Rows are independent and no row is moved: no shuffle, no key, no state between rows.  Null texts
have no words.  Texts without words or runs have no runs, and all their words stay.  Equal
rows each give their row.  An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.words import U64, Words, chunks, mix, powers, texts

#: words appended in one step
STEP = 1 << 17


class Catchers:
    """Catchers over the texts of a chunk; ``first[r]:first[r + 1]`` are the words of text r.

    ``exponent`` is the least length of a run over its period, 2 or more; ``length`` its least
    number of words.
    """

    def __init__(self, first: np.ndarray, exponent: int = 4, length: int = 6) -> None:
        if exponent < 2:
            raise ValueError("a run holds a square: its exponent is 2 or more")
        counts = np.diff(first)
        self.exponent, self.length = exponent, length
        self.begin = np.repeat(first[:-1], counts)
        self.end = np.repeat(first[1:], counts)
        self.total = int(first[-1])
        self.prefix = np.zeros(self.total + 1, U64)
        self.size = 0
        longest = int(counts.max(initial=0))
        #: (2^k, block size) of each level some text has room for
        self.levels = [
            (1 << k, max(1, 1 << k >> 1)) for k in range(longest.bit_length()) if exponent << k <= longest
        ]
        self.caught: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.levels]
        self.raised, self.lowered = powers(self.total + 1)

    def append(self, values: np.ndarray) -> None:
        """Advance by the hashes of the next words."""
        for at in range(0, len(values), STEP):
            self._step(values[at : at + STEP])

    def _hash(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.lowered[start]

    def _step(self, values: np.ndarray) -> None:
        old, new = self.size, self.size + len(values)
        np.cumsum(values * self.raised[old:new], out=self.prefix[old + 1 : new + 1])
        self.prefix[old + 1 : new + 1] += self.prefix[old]
        self.size = new
        for level, (least, size) in enumerate(self.levels):
            # suffixes of a block's size that end with one of the new words, where a catcher lives
            start = np.arange(max(0, old - size + 1), new - size + 1)
            begin, end = self.begin[start], self.end[start]
            room = np.maximum(self.length, self.exponent * least)
            start = start[(start - begin >= least) & (start + size <= end) & (end - begin >= room)]
            if not len(start):
                continue
            begin, suffix = self.begin[start], self._hash(start, size)
            newest = (start - begin - least) // size * size + begin
            for block in (newest,) if least == 1 else (newest, newest - size):
                equal = (block >= begin) & (self._hash(np.maximum(block, 0), size) == suffix)
                if equal.any():
                    self.caught[level].append((block[equal], (start - block)[equal]))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of the runs among the words so far, by start, then period."""
        found = [self._merge(size, pairs) for (_, size), pairs in zip(self.levels, self.caught) if pairs]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        start, length, period = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        # multiples of a run's period have its very ends: the least one comes first
        keep = np.ones(len(start), bool)
        keep[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[keep], length[keep], period[keep]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]

    def _merge(self, size: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        block, period = (np.concatenate(c) for c in zip(*pairs))
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        opens = np.ones(len(block), bool)
        opens[1:] = (
            (period[1:] != period[:-1])
            | (block[1:] != block[:-1] + size)
            | (self.begin[block[1:]] != self.begin[block[:-1]])
        )
        heads = np.flatnonzero(opens)
        blocks = np.diff(np.append(heads, len(block)))
        block, period = block[heads], period[heads]
        # so many words equal the one a period on, and so many whole blocks lie among any of that number
        agree = np.maximum(self.length, self.exponent * period) - period
        some = blocks >= np.maximum((agree + 1) // size - 1, 1)
        block, period, blocks, agree = block[some], period[some], blocks[some], agree[some]
        stop = block + blocks * size
        begin, end = self.begin[block], np.minimum(self.end[block], self.size)
        left = self._extend(block, period, np.minimum(block - begin, size - 1), -1)
        right = self._extend(stop, period, np.minimum(end - stop - period, size - 1), 1)
        start, equal = block - left, stop + right - block + left
        some = equal >= agree
        return start[some], (equal + period)[some], period[some]

    def _extend(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words from ``at`` on (way 1) or before it (-1) equal the ones a period later."""
        known = np.zeros(len(at), np.int64)
        step = 1 << max(int(most.max(initial=0)).bit_length() - 1, 0)
        while step:
            more = known + step
            try_ = np.flatnonzero(more <= most)
            one = at[try_] - (more[try_] if way < 0 else 0)
            equal = self._hash(one, more[try_]) == self._hash(one + period[try_], more[try_])
            known[try_[equal]] += step
            step >>= 1
        return known


def hash_free_runs(words: Sequence[bytes], exponent: int, length: int) -> list[tuple[int, int, int]]:
    """The same runs by comparing words at every distance: for texts whose hashes have deceived."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found: dict[tuple[int, int], int] = {}
    for period in range(1, len(ids) // exponent + 1):
        equal = np.zeros(len(ids) - period + 2, np.int8)
        equal[1:-1] = ids[period:] == ids[:-period]
        turns = np.flatnonzero(np.diff(equal))
        for start, stop in zip(turns[::2].tolist(), turns[1::2].tolist()):
            size = stop - start + period
            if size >= max(length, exponent * period):
                found.setdefault((start, size), period)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def find_runs(words: Words, exponent: int = 4, length: int = 6) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each row, starts counted from its first word; words are compared."""
    catchers = Catchers(words.first, exponent, length)
    catchers.append(mix(words.hashes()))
    starts, lengths, periods = catchers.runs()
    rows = np.searchsorted(words.first, starts, side="right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(words.first) - 1)]
    for row, start, size, period in zip(rows.tolist(), starts.tolist(), lengths.tolist(), periods.tolist()):
        out[row].append((start - int(words.first[row]), size, period))
    for row in set(rows.tolist()):
        own = row_words(words, row)
        if any(own[s : s + n - p] != own[s + p : s + n] for s, n, p in out[row]):
            out[row] = hash_free_runs(own, exponent, length)
    return out


def row_words(words: Words, row: int) -> list[bytes]:
    return words.data[words.offsets[row] : words.offsets[row + 1]].tobytes().split()


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; of equal ones that of least start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that a run holds after its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        steps[start + period] += 1
        steps[start + size] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
NAMES = ("n_words", "runs", "greatest", "collapsed_text", "collapsed_sha256")


def periodic_runs(
    docs: DataFrame, text_col: str = "text", exponent: int = 4, length: int = 6, with_text: bool = True
) -> DataFrame:
    """``docs`` with n_words, its ``runs`` by start and period, the ``greatest`` of them (null: none),
    collapsed_text (one period of every run and all other words, joined by a space) and its SHA-256.

    Runs have ``exponent`` periods and ``length`` words or more.  Columns of those names are
    replaced.  ``with_text=False`` leaves out collapsed_text.
    """
    source, inner, kept = carried(docs, text_col, NAMES)
    outputs = [n for n in NAMES if with_text or n != "collapsed_text"]
    kinds = dict(zip(NAMES, ("long", T.ArrayType(RUN), RUN, "string", "string")))
    schema = source.select(*inner).schema
    for name in outputs:
        schema = schema.add(name, kinds[name])
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    arrow = dict(zip(NAMES, (pa.int64(), pa.list_(run), run, pa.string(), pa.string())))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.columns[-1])
            made: dict[str, list] = {name: [] for name in NAMES}
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                words = Words(data[offsets[first] : offsets[last]], own)
                made["n_words"] += words.counts().tolist()
                for row, runs in enumerate(find_runs(words, exponent, length)):
                    left = row_words(words, row)
                    if runs:
                        left = collapsed(left, runs)
                    text = b" ".join(left)
                    best = greatest(runs)
                    made["runs"].append([dict(zip(("start", "length", "period"), r)) for r in runs])
                    made["greatest"].append(best and dict(zip(("start", "length", "period"), best)))
                    made["collapsed_sha256"].append(hashlib.sha256(text).hexdigest())
                    if with_text:
                        made["collapsed_text"].append(text.decode())
            columns = [pa.array(made[n], arrow[n]) for n in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*inner, *outputs])

    return source.mapInArrow(work, schema).select(*restored(inner, kept), *outputs)
