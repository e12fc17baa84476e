"""Near-duplicate documents: a MinHash signature-coordinate inverted join, confirmed on full sets.

A document's set is its distinct runs of ``width`` words.  Two documents link when the
Jaccard similarity of their sets is at least ``percent``; a component is what links connect.

1. Documents of equal sets form a class; classes take the place of documents from here on.
2. A class's signature has ``COORDINATES`` minima.  It is posted under its coordinate-value
   pairs.  Links of ``percent`` agree in ``least_matches(percent)`` coordinates, but for one in 10^7.
   Two classes that agree in m coordinates share one of their COORDINATES - m + 1 rarest pairs
   (the prefix), so only those are posted, pairs no other class has are skipped, and sets of too
   different sizes never meet (bands).  Texts that share much less than that, such as a common
   passage, mostly have enough pairs of their own for their prefix and are not posted at all.
   Posted classes count the coordinates they share; those below the match threshold are dropped.
3. What collides forms groups; a spanning forest of each posting list is all that is kept of its
   pairs, and classes that a list has connected already are skipped when it is merged on.
4. Within a group sets are compared exactly.  A group larger than a block is cut into blocks
   and each pair of blocks is a unit of its own, so no task holds a group.  Units return a
   spanning forest of their links, from which components follow.

Words are lower-cased in A-Z.  Null and empty texts have empty sets, which link with nothing:
each is a component of its own.  A null doc_id is never a component's name and not kept; rows that
share a doc_id are one document with several texts as far as names go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.columns import modest_batches
from tallyweave.llm.components import components
from tallyweave.llm.repeats import bit_table, cells, has_bit
from tallyweave.llm.words import U64, Words, as_long, chunks, mix, texts, window_hash
from tallyweave.session import shared_folder

SHINGLE = 3
PERCENT = 85
COORDINATES = 64
#: links of the least similarity that may have too few matches
MISSED = 1e-7
BLOCK = 512
_FILTER_BITS = 26

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=U64)) | U64(1)
_SHIFTS = mix(np.arange(1001, COORDINATES + 1001, dtype=U64))


def least_matches(percent: int) -> int:
    """The number of equal coordinates that links of ``percent`` reach, all but a share of ``MISSED``."""
    if not 25 <= percent <= 100:
        raise ValueError("similarities from 25 to 100 percent can be told by the coordinates")
    p, fewer, least = percent / 100, 0.0, 0
    while least < COORDINATES:
        fewer += math.comb(COORDINATES, least) * p**least * (1 - p) ** (COORDINATES - least)
        if fewer > MISSED:
            break
        least += 1
    return least


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    words = Words(data, offsets, fold=True)
    hashes = words.hashes()
    grams = window_hash(hashes, width)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(grams[lo : hi - width + 1]))
        elif hi > lo:
            out.append(window_hash(hashes[lo:hi], hi - lo) ^ U64(hi - lo))
        else:
            out.append(hashes[:0])
    return out


def class_of(found: np.ndarray) -> int:
    """A name of a set that does not depend on order."""
    total, either = np.add.reduce(found, dtype=U64), np.bitwise_xor.reduce(found)
    return int(mix(np.array([total, either, len(found)], U64)).dot(_FACTORS[:3]).view(np.int64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The values of all coordinates of non-empty sets, a row per set.

    32 bits of a minimum are its value: others that share them by chance only propose.
    """
    start = np.cumsum([0] + [len(s) for s in sets[:-1]])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), COORDINATES), U64)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat((flat * _FACTORS[k]) ^ _SHIFTS[k], start)
    return (mix(out + _FACTORS[None, :]) >> U64(32)).astype(np.uint32)


def _describe(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                sets = shingle_sets(data[offsets[first] : offsets[last]], own, width)
                some = [s for s in sets if len(s)]
                values = signatures(some) if some else np.zeros((0, COORDINATES), np.uint32)
                place = np.cumsum([len(s) > 0 for s in sets]) - 1
                full = [int(place[i]) if len(s) else None for i, s in enumerate(sets)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([None if i is None else values[i].view(np.int32) for i in full], pa.list_(pa.int32())),
                        # a byte of each: enough to count equal ones
                        pa.array([None if i is None else values[i].astype(np.uint8).tobytes() for i in full], pa.binary()),
                    ],
                    names=["id", "class", "n", "pairs", "marks"],
                )

    return work


def forest(a: np.ndarray, b: np.ndarray, n: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """What edges (a, b) on n nodes add to a spanning forest of the ``known`` ones."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    known = np.zeros(len(a), bool) if known is None else known
    for wanted in (True, False):
        part = known == wanted
        for x, y in zip(a[part].tolist(), b[part].tolist()):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[rx] = ry
                if not wanted:
                    out.append((x, y))
    return out


def _collide(matches: int, percent: int):
    """Over postings sorted by (unit, i, j): a forest of the classes that share enough coordinates.

    A pair that another unit holds as well, both of one block or both guests from the band
    below, counts as known here and is returned there.
    """

    def settle(rows: list[tuple]) -> list[tuple[int, int]]:
        n = len(rows)
        marks = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(n, COORDINATES)
        sizes = np.array([r[4] for r in rows])
        guest = np.array([r[6] for r in rows], bool)
        own = np.array([r[7] for r in rows])
        within = rows[0][1] == rows[0][2]
        part, out = np.arange(n), []
        for at in range(n - 1):
            # what the list has connected with this class is skipped
            rest = np.flatnonzero(part[at + 1 :] != part[at]) + at + 1
            if not len(rest):
                continue
            near = (marks[rest] == marks[at]).sum(axis=1) >= matches
            lo, hi = np.minimum(sizes[rest], sizes[at]), np.maximum(sizes[rest], sizes[at])
            found = rest[near & (100 * lo >= percent * hi)]
            if not len(found):
                continue
            known = guest[found] & guest[at]
            if not within:
                known |= own[found] == own[at]
            found = np.concatenate([found[known], found[~known]])
            joined, first = np.unique(part[found], return_index=True)
            out += [(rows[at][3], rows[y][3]) for y in found[first[first >= known.sum()]].tolist()]
            part[np.isin(part, joined)] = part[at]
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        edges: list[tuple[int, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[0][:3]:
                    edges.extend(settle(held))
                    held = []
                    if len(edges) > 20_000:
                        yield _edges(edges)
                        edges = []
                held.append(row)
        if held:
            edges.extend(settle(held))
        yield _edges(edges)

    return work


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    found = list(dict.fromkeys(found))
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"]
    )


def linked(sets: list[np.ndarray], percent: int, own: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between some sets, all compared exactly.

    Links within a block of ``own`` count as known.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, where, times = np.unique(flat, return_inverse=True, return_counts=True)
    # shingles of one set only are in no intersection
    shared = times > 1
    column = (np.cumsum(shared) - 1)[where]
    use = shared[where]
    owner, column = owner[use], column[use]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    wide = 4096
    for at in range(0, int(shared.sum()), wide):
        lo, hi = np.searchsorted(column, [at, at + wide])
        part = np.zeros((n, wide), np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        both += part @ part.T
    total = sizes[:, None] + sizes[None, :] - both
    a, b = np.nonzero(np.triu(100 * both >= percent * total, 1))
    return forest(a, b, n, None if own is None else own[a] == own[b])


def _confirm(percent: int):
    """Over rows (unit columns, class, set) sorted by unit: a forest of the exact links of each unit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, names, sets, blocks, edges = None, [], [], [], []

        def settle() -> None:
            if len(names) > 1:
                own = np.array(blocks) if unit[1] != unit[2] else None
                edges.extend((names[x], names[y]) for x, y in linked(sets, percent, own))

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, name, raw, own in zip(zip(*columns[:3]), *columns[3:]):
                if key != unit:
                    settle()
                    unit, names, sets, blocks = key, [], [], []
                    if len(edges) > 20_000:
                        yield _edges(edges)
                        edges = []
                # rows of one class follow one another: copies of its text
                if not names or names[-1] != name:
                    names.append(name)
                    sets.append(np.frombuffer(raw, U64))
                    blocks.append(own)
        settle()
        yield _edges(edges)

    return work


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    block: int = BLOCK,
    width: int = SHINGLE,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; kept rows are named like their component.

    Texts are read twice and never shuffled.  ``block`` bounds the sets a task compares at once.
    Components that have not settled after the rounds of ``components`` end the run with an error.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    path = shared_folder(spark, "near-dups")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    source.mapInArrow(_describe(width), f"id {id_type}, class long, n long, pairs array<int>, marks binary").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    (
        rows.where("n > 0")
        .groupBy("class")
        .agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("pairs").alias("pairs"), F.first("marks").alias("marks")
        )
        .write.parquet(f"{path}/classes")
    )
    classes = spark.read.parquet(f"{path}/classes")

    # the prefix: of the pairs in order of rarity, those another class has as well
    matches = least_matches(percent)
    coordinate = classes.select("class", F.posexplode("pairs").alias("k", "v"))
    posted = coordinate.select("class", F.expr("shiftleft(CAST(k AS BIGINT), 32) + (CAST(v AS BIGINT) & 4294967295)").alias("pair"))
    common = posted.groupBy("pair").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    length = COORDINATES - matches + 1
    prefix = (
        posted.join(common, "pair")
        .groupBy("class")
        .agg(F.array_sort(F.collect_list(F.struct("df", "pair"))).alias("p"))
        .select("class", F.expr(f"slice(p, 1, greatest({length} - ({COORDINATES} - size(p)), 0))").alias("p"))
        .where("size(p) > 0")
    )
    # sets that link are of one band or of two neighbouring ones
    band = F.col("n") * 2 if percent == 100 else F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9)
    entries = (
        prefix.join(classes.select("class", "n", "marks", band.alias("band")), "class")
        .select("class", "n", "marks", "band", F.explode("p.pair").alias("pair"))
        .select("class", "n", "marks", "pair", "band", F.explode(F.array(F.lit(False), F.lit(True))).alias("guest"))
        .withColumn("band", F.col("band") + F.col("guest").cast("int"))
    )
    entries.write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    # lists with more than a block of classes are cut into pairs of blocks
    lists = (
        entries.groupBy("pair", "band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        .select("pair", "band", F.ceil(F.col("m") / block).alias("blocks"))
    )
    ready = _blocked(entries.join(lists, ["pair", "band"]), ["pair", "band"]).select(
        "unit", "i", "j", "class", "n", "marks", "guest", "own"
    )
    colliding = (
        ready.repartition("unit", "i", "j")
        .sortWithinPartitions("unit", "i", "j", "class")
        .mapInArrow(_collide(matches, percent), "a long, b long")
    )
    groups = components(colliding)
    groups.write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")

    # the sets of grouped classes, from the texts; a bit table of fixed size spares the others
    def both_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([as_long(np.concatenate(cells(mix(keys), _FILTER_BITS)))], names=["cell"])

    table = bit_table(groups.select("node").mapInArrow(both_cells, "cell long"), _FILTER_BITS + 1)
    wanted = spark.sparkContext.broadcast(table)

    def grouped_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # one set of a class is enough; forgotten from time to time
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for first, last in chunks(offsets):
                own = offsets[first : last + 1] - offsets[first]
                sets = [s for s in shingle_sets(data[offsets[first] : offsets[last]], own, width) if len(s)]
                if not sets:
                    continue
                names = np.array([class_of(s) for s in sets], np.int64)
                one, two = cells(mix(names.view(np.uint64)), _FILTER_BITS)
                picked = np.flatnonzero(has_bit(wanted.value, one) & has_bit(wanted.value, two)).tolist()
                picked = [i for i in picked if int(names[i]) not in seen and not seen.add(int(names[i]))]
                if len(seen) > 100_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[picked]), pa.array([sets[i].tobytes() for i in picked], pa.binary())],
                    names=["node", "set"],
                )

    sets = source.select("text").mapInArrow(grouped_sets, "node long, set binary")
    sized = groups.join(
        groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")), "root"
    ).withColumnRenamed("node", "class")
    placed = sized.join(sets.withColumnRenamed("node", "class"), "class")
    units = _blocked(placed, ["root"]).select("unit", "i", "j", "class", "set", "own")
    links = (
        units.repartition("unit", "i", "j")
        .sortWithinPartitions("unit", "i", "j", "class")
        .mapInArrow(_confirm(percent), "a long, b long")
    )
    found = components(links)

    names = classes.select("class", "id").join(found.withColumnRenamed("node", "class"), "class")
    least = names.groupBy("root").agg(F.min("id").alias("component"))
    joined = names.select("class", "root").join(least, "root").select("class", "component")
    alone = classes.join(joined, "class", "left").select(
        "class", F.least("id", F.coalesce("component", "id")).alias("component")
    )
    out = rows.select("id", "class", "n").join(alone, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _blocked(members: DataFrame, keys: list[str]) -> DataFrame:
    """``members`` (with ``class`` and ``blocks``) under every pair of blocks (i, j) its own block is in."""
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    unit = F.xxhash64(*keys) if len(keys) > 1 else F.col(keys[0])
    return (
        members.withColumn("unit", unit)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
    )
