"""Removal of byte strings that start more than once in a corpus, by sorting suffixes.

Two strings of ``WIDTH`` bytes can only be equal if their anchors are (``repeats``): the
leftmost of the least-hashed runs of ``GRAM`` bytes inside, at the same distance from the
start.  Starts that share an anchor form a *run*: a short stretch of text.

1. The merged count-min sketch of all anchors tells runs that may repeat from those that cannot.
2. Runs that may repeat are counted by anchor.  Where all runs of an anchor are the same
   stretch of text (128 bits of hash), two or more of them repeat as a whole.
3. What is left, runs that agree in part, meets by anchor.  A task sorts the suffixes at
   their starts, those of one anchor and one distance together: a merge sort whose comparisons
   find the common extension of two suffixes by binary search over prefix polynomial
   hashes.  Neighbours that agree on ``WIDTH`` bytes are compared byte by byte before they
   count; if a hash has lied, the segment is sorted anew by its bytes.
4. An anchor with more than ``CROWD`` different stretches does not go to one task: each of
   its strings is counted by a hash of 128 bits with partial sums, and those that
   occur once return to the one text that holds them.

A text drops the bytes covered by its repeated strings.  Texts are told apart by content;
equal texts are copies, whose strings all repeat.  Null and empty texts, and texts shorter
than ``WIDTH``, lose nothing.  The result has a row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tallyweave.llm.columns import carried, restored
from tallyweave.llm.repeats import bit_table, cells, estimated_repeated, repeated_cells, sketch_bits, text_bytes
from tallyweave.llm.words import U64, as_long, byte_prefix, fits, fixed_hash, mix, range_hash, sliding, texts
from tallyweave.session import shared_folder

WIDTH = 200
GRAM = 100
CROWD = 4096
_PIECE = 1 << 19
_PLACE_BITS = 24
_BATCH_BYTES = 2 << 20
# about one anchor in (WIDTH - GRAM + 2) / 2 bytes
_BYTES_PER_ANCHOR = 51


class Runs:
    """The runs of some texts: starts of whole strings that share an anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> None:
        self.data, self.width = data, width
        self.prefix = byte_prefix(data)
        valid = fits(offsets, width)
        span, n = width - gram + 1, len(data)
        grams = fixed_hash(self.prefix, gram)
        place = U64((1 << _PLACE_BITS) - 1)
        packed = np.full(n + span - 1, np.iinfo(np.uint64).max, U64)
        packed[: len(grams)] = (grams & ~place) | np.arange(len(grams), dtype=U64)
        # leftmost on ties, as the place fills the low bits
        at = (sliding(np.minimum, packed, span)[:n] & place).astype(np.int64)
        starts = np.flatnonzero(valid)
        own = at[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (own[1:] != own[:-1]) | (np.diff(starts) != 1)
        head = np.flatnonzero(new)
        #: first start, number of starts, distance from the first start to the anchor
        self.start = starts[head]
        self.count = np.diff(np.append(head, len(starts)))
        self.distance = own[head] - self.start
        self.key = grams[own[head]]

    def ends(self) -> np.ndarray:
        return self.start + self.count - 1 + self.width

    def names(self) -> np.ndarray:
        """A second hash of each run: its stretch of text and where the anchor stands in it."""
        prefix = byte_prefix(self.data, 1)
        return mix(range_hash(prefix, self.start, self.ends(), 1) + self.distance.astype(U64))


    def twins(self, row: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the runs ``some``: flags of those with an equal run in their own text, and of the first of each kind.

        ``row`` is the text of each run.  A run with a twin repeats as a whole, so one of them can
        stand for all where they are compared with other texts.
        """
        names = self.names()[some]
        order = np.lexsort((names, self.key[some], row[some]))
        fields = [row[some][order], self.key[some][order], names[order]]
        new = np.append(True, np.any([f[1:] != f[:-1] for f in fields], axis=0)) if len(order) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        several = np.bincount(group, minlength=1)[group] > 1 if len(order) else new
        has, first = np.zeros(len(some), bool), np.zeros(len(some), bool)
        has[order], first[order] = several, new
        return has, first


def pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """(first row, end of the slice's rows, offsets within the slice, slice start in the batch).

    Short texts go together; a text longer than a piece is cut into pieces that overlap by
    ``width`` - 1 bytes, so that every string lies in exactly one of them.
    """
    n, first = len(offsets) - 1, 0
    while first < n:
        size = int(offsets[first + 1] - offsets[first])
        if size > _PIECE:
            for at in range(0, size - width + 1, _PIECE):
                yield first, first + 1, np.array([0, min(_PIECE + width - 1, size - at)]), int(offsets[first]) + at
            first += 1
            continue
        last = int(np.searchsorted(offsets, offsets[first] + _PIECE, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, offsets[first : last + 1] - offsets[first], int(offsets[first])
        first = last


def merge_sort(data: np.ndarray, at: np.ndarray, segment: np.ndarray, width: int) -> np.ndarray:
    """Sort the strings at ``at`` within their segments; the result is a permutation.

    ``segment`` is non-decreasing.  Bottom-up merging of all segments at once: each element
    finds its place in the neighbouring block by binary search, each comparison the common
    extension by binary search over prefix hashes.
    """
    prefix = byte_prefix(data)
    n = len(at)
    order = np.arange(n)
    edge = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    size = np.diff(np.append(edge, n))
    base = np.repeat(edge, size)
    total = np.repeat(size, size)
    block = 1
    while block < (int(size.max()) if n else 0):
        slot = np.flatnonzero(total > block)
        local = slot - base[slot]
        mine = local // block
        pair = (mine >> 1) * 2 * block
        low = np.minimum(np.where(mine & 1 == 0, pair + block, pair), total[slot])
        high = np.minimum(low + block, total[slot])
        left = mine & 1 == 0
        lo, hi = low.copy(), high.copy()
        me = at[order[slot]]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            middle = (lo[open_] + hi[open_]) >> 1
            other = at[order[base[slot[open_]] + middle]]
            less, same = compare(data, prefix, other, me[open_], width)
            # elements of the left block stay before equal ones of the right block
            go = less | (same & ~left[open_])
            lo[open_[go]] = middle[go] + 1
            hi[open_[~go]] = middle[~go]
        target = base[slot] + pair + (local - mine * block) + (lo - low)
        moved = order[slot]
        order[target] = moved
        block *= 2
    return order


def compare(data: np.ndarray, prefix: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the string at ``a`` is less than that at ``b``, and whether both are equal."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), width)
    while True:
        wide = np.flatnonzero(low < high)
        if not len(wide):
            break
        middle = (low[wide] + high[wide] + 1) >> 1
        x, y = a[wide], b[wide]
        agree = range_hash(prefix, x, x + middle) == range_hash(prefix, y, y + middle)
        low[wide[agree]] = middle[agree]
        high[wide[~agree]] = middle[~agree] - 1
    same = low >= width
    step = np.minimum(low, width - 1)
    return ~same & (data[a + step] < data[b + step]), same


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(data, width)
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), 20_000):
        out[at : at + 20_000] = (view[a[at : at + 20_000]] == view[b[at : at + 20_000]]).all(axis=1)
    return out


def repeated_starts(data: np.ndarray, at: np.ndarray, segment: np.ndarray, width: int) -> np.ndarray:
    """Flags of the strings equal to another one of their segment."""
    by = np.argsort(segment, kind="stable")
    at_, segment_ = at[by], segment[by]
    edge = np.append(True, segment_[1:] != segment_[:-1])
    alone = edge & np.append(edge[1:], True)
    flags = np.zeros(len(at), bool)
    some = np.flatnonzero(~alone)
    if not len(some):
        return flags
    by, at_, segment_ = by[some], at_[some], segment_[some]
    order = merge_sort(data, at_, segment_, width)
    at_, by = at_[order], by[order]
    near = np.flatnonzero(segment_[1:] == segment_[:-1])
    prefix = byte_prefix(data)
    agree = near[
        range_hash(prefix, at_[near], at_[near] + width) == range_hash(prefix, at_[near + 1], at_[near + 1] + width)
    ]
    sure = equal_bytes(data, at_[agree], at_[agree + 1], width)
    flags[by[agree[sure]]] = True
    flags[by[agree[sure] + 1]] = True
    for liar in np.unique(segment_[agree[~sure]]).tolist():
        members = np.flatnonzero(segment_ == liar)
        strings = [data[p : p + width].tobytes() for p in at_[members].tolist()]
        ranked = sorted(range(len(members)), key=strings.__getitem__)
        flags[by[members]] = False
        for x, y in zip(ranked, ranked[1:]):
            if strings[x] == strings[y]:
                flags[by[members[x]]] = flags[by[members[y]]] = True
    return flags


def _intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of set flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _compare_runs(width: int):
    """Over rows (key, name, at, n, distance, stretch) sorted by key: the repeated starts of each text."""

    def settle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        # equal stretches repeat as a whole wherever they stand; one of them is compared with the others
        holders: dict[tuple, dict[tuple[int, int], int]] = {}
        for key, name, at, n, distance, stretch in rows:
            places = holders.setdefault((key, n, distance, stretch), {})
            places[name, at] = places.get((name, at), 0) + 1  # more than one: copies of a text
        members = list(holders)
        data = np.frombuffer(b"".join(m[3] for m in members), np.uint8)
        size = np.array([len(m[3]) for m in members])
        base = np.cumsum(size) - size
        count = np.array([m[1] for m in members])
        keys = np.unique(np.array([m[0] for m in members]), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(members)), count)
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        distance = np.array([m[2] for m in members])[owner] - step
        flags = repeated_starts(data, base[owner] + step, keys[owner] * (width + 1) + distance, width)
        flags |= np.array([sum(places.values()) > 1 for places in holders.values()])[owner]
        edge = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
        names, froms, tos = [], [], []
        for i in np.unique(owner[flags]).tolist():
            first, last = _intervals(flags[edge[i] : edge[i + 1]])
            for name, at in holders[members[i]]:
                names.extend([name] * len(first))
                froms.extend((first + at).tolist())
                tos.extend((last + at).tolist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(froms, pa.int64()), pa.array(tos, pa.int64())],
            names=["name", "first", "last"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if weight > _BATCH_BYTES and row[0] != held[-1][0]:
                    yield from settle(held)
                    held, weight = [], 0
                held.append(row)
                weight += len(row[5])
        if held:
            yield from settle(held)

    return work


NAMES = ("n_bytes", "n_removed", "n_spans", "kept_text", "kept_sha256")


def remove_repeated_bytes(
    docs: DataFrame,
    text_col: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    bits: int | None = None,
    crowd: int = CROWD,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (long), kept_text (binary) and kept_sha256.

    Columns of those names are replaced.  ``with_text=False`` leaves out kept_text.  Texts are
    read four times, five where there are crowds; what is shuffled are the anchors' counts, the
    runs to be sorted, and the texts that wait for their verdict.
    """
    if not 1 <= gram <= width:
        raise ValueError("a gram is a part of its string")
    spark = docs.sparkSession
    path = shared_folder(spark, "suffixes")
    if bits is None:
        bits = sketch_bits(text_bytes(docs, text_col) // _BYTES_PER_ANCHOR)
    named = docs.select(F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{text_col}`").alias("name"))

    def anchors_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = [
            Runs(data[at : at + own[-1]], own, width, gram).key for _, _, own, at in pieces(offsets, width)
        ]
        return np.concatenate(out) if out else np.zeros(0, U64)

    sketch = spark.sparkContext.broadcast(repeated_cells(docs, anchors_of, bits, text_col))

    def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for _, _, own, at in pieces(offsets, width):
                runs = Runs(data[at : at + own[-1]], own, width, gram)
                some = estimated_repeated(sketch.value, runs.key, bits)
                pairs = np.stack([runs.key[some], runs.names()[some]], axis=1)
                if not len(pairs):
                    continue
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                pairs = pairs[order]
                new = np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))
                n = np.diff(np.append(np.flatnonzero(new), len(pairs)))
                pairs = pairs[new]
                yield pa.RecordBatch.from_arrays(
                    [as_long(pairs[:, 0]), as_long(pairs[:, 1]), pa.array(np.minimum(n, 2).astype(np.int32))],
                    names=["key", "run", "n"],
                )

    counted = (
        named.select("text")
        .mapInArrow(count_runs, "key long, run long, n int")
        .groupBy("key")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"), F.min("run").alias("a"), F.max("run").alias("b"))
        .where("n = 1 OR a <> b")
        .select("key", "kinds")
    )
    counted.write.parquet(f"{path}/mixed")
    mixed = spark.read.parquet(f"{path}/mixed")

    # these tables hold a small part of the anchors; a false alarm sends a run the longer way
    few = max(bits - 3, 10)

    def key_table(keys: DataFrame) -> np.ndarray:
        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = batch.column(0).to_numpy().view(np.uint64)
                yield pa.RecordBatch.from_arrays([as_long(np.concatenate(cells(found, few)))], names=["cell"])

        return bit_table(keys.select("key").mapInArrow(both, "cell long"), few + 1)

    partly = spark.sparkContext.broadcast(key_table(mixed))
    crowds = mixed.where(F.col("kinds") > crowd)
    crowded = spark.sparkContext.broadcast(key_table(crowds))

    def kinds(keys: np.ndarray) -> np.ndarray:
        """0: cannot repeat, 1: repeats as a whole, 2: to be sorted, 3: to be counted string by string."""
        several = estimated_repeated(crowded.value, keys, few)
        some = np.where(estimated_repeated(partly.value, keys, few), np.where(several, 3, 2), 1)
        return np.where(estimated_repeated(sketch.value, keys, bits), some, 0)

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, Runs, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Each slice's bytes, runs, their kinds, rows in the slice, rows in the batch and shifts to places in texts."""
        data, offsets = texts(batch.column(0))
        for first, _, own, at in pieces(offsets, width):
            part = data[at : at + own[-1]]
            runs = Runs(part, own, width, gram)
            row = np.searchsorted(own, runs.start, side="right") - 1
            yield part, runs, kinds(runs.key), row, first + row, at - offsets[first + row]

    def post_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_numpy(zero_copy_only=False)
            for part, runs, kind, near, row, shift in slices(batch):
                todo = np.flatnonzero(kind == 2)
                todo = todo[runs.twins(near, todo)[1]]
                raw, ends = part.tobytes(), runs.ends()
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(runs.key[todo]),
                        pa.array(names[row[todo]]),
                        pa.array(runs.start[todo] + shift[todo]),
                        pa.array(runs.count[todo].astype(np.int32)),
                        pa.array(runs.distance[todo].astype(np.int32)),
                        pa.array(
                            [raw[s:e] for s, e in zip(runs.start[todo].tolist(), ends[todo].tolist())], pa.binary()
                        ),
                    ],
                    names=["key", "name", "at", "n", "distance", "stretch"],
                )

    def post_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_numpy(zero_copy_only=False)
            for part, runs, kind, _, row, shift in slices(batch):
                many = np.flatnonzero(kind == 3)
                if not len(many):
                    continue
                count = runs.count[many]
                owner = np.repeat(many, count)
                start = runs.start[owner] + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        as_long(range_hash(runs.prefix, start, start + width)),
                        as_long(range_hash(byte_prefix(part, 1), start, start + width, 1)),
                        pa.array(names[row[owner]]),
                        pa.array(start + shift[owner]),
                    ],
                    names=["high", "low", "name", "at"],
                )

    # a run goes to the task of its anchor and comes back as the stretches of it that repeat
    verdicts = (
        named.mapInArrow(post_runs, "key long, name long, at long, n int, distance int, stretch binary")
        .repartition("key")
        .sortWithinPartitions("key", "name", "at")
        .mapInArrow(_compare_runs(width), "name long, first long, last long")
        .select("name", F.lit(True).alias("again"), "first", "last")
    )
    if not crowds.isEmpty():
        once = (
            named.mapInArrow(post_strings, "high long, low long, name long, at long")
            .groupBy("high", "low")
            .agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"), F.min("at").alias("at"))
            .where("n = 1")
            .select("name", F.lit(False).alias("again"), F.col("at").alias("first"), F.col("at").alias("last"))
        )
        verdicts = verdicts.unionByName(once)
    # copies of a text have posted the same runs
    by_text = verdicts.groupBy("name").agg(F.collect_set(F.struct("again", "first", "last")).alias("v"))

    carry, inner, kept = carried(docs, text_col, NAMES)
    outputs = [n for n in NAMES if with_text or n != "kept_text"]
    kinds_of = {"kept_text": "binary", "kept_sha256": "string"}
    out_schema = carry.select(*inner).schema
    for name in outputs:
        out_schema = out_schema.add(name, kinds_of.get(name, "long"))
    open_schema = carry.select(*inner).schema.add("name", "long").add("text", "string")
    for name in ("firsts", "lasts"):
        open_schema = open_schema.add(name, ArrayType(LongType()))
    for name in outputs:
        open_schema = open_schema.add(name, kinds_of.get(name, "long"))
    arrow = {"kept_text": pa.binary(), "kept_sha256": pa.string()}

    def result(raw: bytes, first: np.ndarray, last: np.ndarray) -> dict[str, object]:
        """What is left of a text whose repeated strings start in [first, last] stretches."""
        end, gone, spans, left = 0, 0, 0, []
        for f, t in zip(first.tolist(), (last + width).tolist()):
            if f > end or not spans:
                left.append(raw[end:f])
                spans += 1
                gone += t - f
            else:
                gone += t - end
            end = t
        left.append(raw[end:])
        text = b"".join(left)
        return {
            "n_bytes": len(raw),
            "n_removed": gone,
            "n_spans": spans,
            "kept_text": text,
            "kept_sha256": hashlib.sha256(text).hexdigest(),
        }

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts none of whose runs were compared are done; the others keep their text for their verdict."""
        k = len(inner)
        for batch in batches:
            data, offsets = texts(batch.column(k))
            hit = np.zeros(len(data) + 1, bool)  # starts of repeated strings
            waits = np.zeros(len(offsets) - 1, bool)
            for first, _, own, at in pieces(offsets, width):
                runs = Runs(data[at : at + own[-1]], own, width, gram)
                kind = kinds(runs.key)
                row = np.searchsorted(own, runs.start, side="right") - 1
                waits[first + row[kind >= 2]] = True
                partial = np.flatnonzero(kind == 2)
                kind[partial[runs.twins(row, partial)[0]]] = 1
                whole = np.flatnonzero((kind == 1) | (kind == 3))
                steps = np.zeros(int(own[-1]) + 1, np.int32)
                steps[runs.start[whole]] += 1
                np.add.at(steps, runs.start[whole] + runs.count[whole], -1)
                hit[at : at + own[-1]] |= np.cumsum(steps[:-1]) > 0
            raw = data.tobytes()
            made: dict[str, list] = {name: [] for name in ("text", "firsts", "lasts", *outputs)}
            for r in range(len(offsets) - 1):
                lo, hi = int(offsets[r]), int(offsets[r + 1])
                first, last = _intervals(hit[lo:hi])
                found = {} if waits[r] else result(raw[lo:hi], first, last)
                made["text"].append(raw[lo:hi].decode() if waits[r] else None)
                made["firsts"].append(first if waits[r] else None)
                made["lasts"].append(last if waits[r] else None)
                for name in outputs:
                    made[name].append(found.get(name))
            types = {"text": pa.string(), "firsts": pa.list_(pa.int64()), "lasts": pa.list_(pa.int64()), **arrow}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], batch.column(k + 1), *[pa.array(v, types.get(n, pa.int64())) for n, v in made.items()]],
                names=[*inner, "name", *made],
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(inner)
        for batch in batches:
            done = [batch.column(k + 3 + i).to_pylist() for i in range(len(outputs))]
            text, firsts, lasts = batch.column(k), batch.column(k + 1), batch.column(k + 2)
            verdict = batch.column(k + 3 + len(outputs))
            for r in range(len(text)):
                if not text[r].is_valid:
                    continue
                raw = text[r].as_py().encode()
                steps = np.zeros(len(raw) + 1, np.int32)
                np.add.at(steps, firsts[r].values.to_numpy(), 1)
                np.add.at(steps, lasts[r].values.to_numpy() + 1, -1)
                starts = np.cumsum(steps[:-1]) > 0
                for v in verdict[r].as_py() or ():
                    starts[v["first"] : v["last"] + 1] = v["again"]
                found = result(raw, *_intervals(starts))
                for column, name in zip(done, outputs):
                    column[r] = found[name]
            columns = [pa.array(v, arrow.get(n, pa.int64())) for n, v in zip(outputs, done)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], *columns], names=[*inner, *outputs])

    opened = carry.withColumn("name", F.xxhash64("text")).mapInArrow(settle, open_schema)
    judged = opened.join(by_text, "name", "left").select(*inner, "text", "firsts", "lasts", *outputs, "v")
    return judged.mapInArrow(finish, out_schema).select(*restored(inner, kept), *outputs)
