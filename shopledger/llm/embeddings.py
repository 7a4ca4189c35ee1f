"""Near-duplicate vectors by counting collisions of one-dimensional projections.

On a random line, the projections of two vectors of cosine c differ by a normal deviate whose
spread depends on c alone. So the chance that two vectors collide, that one's projection
falls into a window around the other's, is known beforehand, and so is the number of
collisions that pairs at the threshold reach with a given chance: the recall that the
operator is asked for sets how many lines there are and which count a pair must reach.

Comparing all pairs along each sorted line would be quadratic. The sorted lines are cut into
windows, and vectors meet if they share the windows of several lines of a table; there
are as many such tables as the recall needs. Pairs that meet are counted over the
query-centred windows of a set of lines, and those that reach the count are verified by
cosine in double precision. A pair that meets in several tables counts in the first only.

Equal vectors are one vector with a multiplicity. A crowded window is cut into blocks, and
each pair of blocks is a task of its own; a task gives sums per vector and a spanning
forest of its links, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import components, stored

MIN_COSINE = 0.9
RECALL = 0.975
# Width of a table's windows, lines that are counted, half width of a counted window.
WIDTH = 2.0
COUNTED = 24
HALF = 0.6
# Vectors of no likeness that share a table's windows with one, about; vectors in a block.
MATES = 256
BLOCK = 1_024
SEED = 20_24
_KEY = ("turn", "bucket", "one", "other")
_SCALE = 1_024  # projections are counted as 16-bit numbers of this unit


@dataclass(frozen=True)
class Lines:
    """Lines per table, tables, and the least count of collisions."""

    per_table: int
    tables: int
    least: int

    def directions(self, size: int) -> np.ndarray:
        rng = np.random.default_rng([SEED, size])
        return rng.standard_normal((size, self.per_table * self.tables + COUNTED))

    def shifts(self) -> np.ndarray:
        return np.random.default_rng(SEED).random(self.per_table * self.tables)


def _shared(spread: float) -> float:
    """Chance that two projections whose difference has this spread share a window."""
    at = np.linspace(0.0, WIDTH, 4_001)
    density = np.exp(-0.5 * (at / spread) ** 2) * 2.0 / (spread * math.sqrt(2.0 * math.pi))
    return float(np.trapezoid(density * (1.0 - at / WIDTH), at))


def lines_for(vectors: int, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> Lines:
    """Lines and tables by which pairs at the threshold are found with the given chance.

    The misses allowed are shared by the tables (two thirds) and the count (one third). More
    vectors need more lines per table, so that windows do not fill up, and then more tables.
    """
    near, far = math.sqrt(max(2.0 - 2.0 * min_cosine, 1e-6)), math.sqrt(2.0)
    per_table = max(2, round(math.log(max(vectors / MATES, 1.0)) / -math.log(_shared(far))))
    missed = 1.0 - recall
    tables = max(1, math.ceil(math.log(missed * 2 / 3) / math.log(1.0 - _shared(near) ** per_table)))
    hit = math.erf(HALF / (near * math.sqrt(2.0)))
    below, least = 0.0, 0
    while True:
        below += math.comb(COUNTED, least) * hit**least * (1.0 - hit) ** (COUNTED - least)
        if below > missed / 3:
            return Lines(per_table, tables, least)
        least += 1


def _units(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    # Scaled first, so that squares of very large or small numbers stay finite.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat**2).sum(axis=1, keepdims=True))


def _windows(units: np.ndarray, lines: Lines, directions: np.ndarray) -> np.ndarray:
    """Per vector and table a hash of the windows it lies in."""
    used = lines.per_table * lines.tables
    cells = np.floor(units @ directions[:, :used] / WIDTH + lines.shifts()).astype(np.int64)
    cells = cells.reshape(len(units), lines.tables, lines.per_table).view(np.uint64)
    mixed = np.full((len(units), lines.tables), units.shape[1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(-1, lines.per_table):
            mixed ^= np.arange(lines.tables, dtype=np.uint64) if k < 0 else cells[:, :, k]
            mixed = (mixed + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def _by_size(batch: pa.RecordBatch, name: str = "embedding") -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a batch by the number of components."""
    sizes = np.asarray(batch.column(name).value_lengths())
    for size in np.unique(sizes).tolist():
        yield size, batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


def _index(vectors: DataFrame, lines: Lines) -> DataFrame:
    """``node, turn, bucket``: the windows of each table that a vector lies in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in _by_size(batch):
                directions = made.setdefault(size, lines.directions(size))
                found = _windows(_units(part.column("embedding"), size), lines, directions)
                turns = np.tile(np.arange(lines.tables, dtype=np.int32), len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("node").to_numpy(), lines.tables)), pa.array(turns), pa.array(found.ravel())],
                    ["node", "turn", "bucket"],
                )

    return vectors.select("node", "embedding").mapInArrow(work, "node long, turn int, bucket long")


def _tasks(index: DataFrame) -> DataFrame:
    """``node, turn, bucket, one, other, mine``: each vector in all pairs of blocks that hold its own."""
    sizes = index.groupBy("turn", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = index.join(sizes, ["turn", "bucket"]).select(
        "node", "turn", "bucket", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("mine"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"),
    )
    return placed.select("node", "turn", "bucket", F.least("mine", "with").alias("one"), F.greatest("mine", "with").alias("other"), "mine")


class _Group:
    """The vectors of one pair of blocks."""

    def __init__(self, lines: Lines, min_cosine: float):
        self.lines, self.min_cosine = lines, min_cosine

    def links(self, turn: int, mine: np.ndarray, one: int, other: int, units: np.ndarray, spots: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs, as two arrays of positions."""
        first = np.flatnonzero(mine == one)
        second = first if one == other else np.flatnonzero(mine == other)
        found: list[np.ndarray] = []
        for at in range(0, len(first), BLOCK):
            a = first[at : at + BLOCK]
            for off in range(at if one == other else 0, len(second), BLOCK):
                b = second[off : off + BLOCK]
                counts = np.zeros((len(a), len(b)), np.uint8)
                for line in range(COUNTED):
                    counts += np.abs(spots[a, line, None] - spots[None, b, line]) <= int(HALF * _SCALE)
                x, y = np.nonzero(counts >= self.lines.least)
                x, y = a[x], b[y]
                if one == other and at == off:
                    x, y = x[x < y], y[x < y]
                found.append(self._verified(turn, x, y, units, cells))
        both = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
        return both[0], both[1]

    def _verified(self, turn: int, x: np.ndarray, y: np.ndarray, units: np.ndarray, cells: np.ndarray) -> np.ndarray:
        kept = [np.zeros((2, 0), np.int64)]
        for at in range(0, len(x), 1 << 16):
            i, j = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
            new = ~(cells[i, :turn] == cells[j, :turn]).any(axis=1)
            i, j = i[new], j[new]
            near = np.einsum("ij,ij->i", units[i], units[j]) >= self.min_cosine
            kept.append(np.stack((i[near], j[near])))
        return np.concatenate(kept, axis=1)


def _roots(count: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest position reachable by the links, for each position."""
    root = np.arange(count)
    while True:
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        low = low[low]
        if np.array_equal(low, root):
            return root
        root = low


def _linked(tasks: DataFrame, lines: Lines, min_cosine: float) -> DataFrame:
    """``node, n_links, root`` per vector and task in which it has links; ``root`` is linked to it there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, directions = _Group(lines, min_cosine), {}
        held: list[pa.RecordBatch] = []

        def solve(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Whole groups; all of one size but where hashes collide."""
            for size, part in _by_size(rows):
                lined = directions.setdefault(size, lines.directions(size))
                units = _units(part.column("embedding"), size)
                spots = np.clip(np.rint(units @ lined[:, -COUNTED:] * _SCALE), -16_000, 16_000).astype(np.int16)
                cells = _windows(units, lines, lined)
                names = ("turn", "bucket", "one", "other", "mine", "node", "copies")
                turn, bucket, one, other, mine, node, copies = (part.column(n).to_numpy() for n in names)
                new = np.any([k[1:] != k[:-1] for k in (turn, bucket, one, other)], axis=0)
                cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(node)]
                out: list[np.ndarray] = []
                for a, b in zip(cuts, cuts[1:]):
                    if b - a < 2:
                        continue
                    x, y = group.links(int(turn[a]), mine[a:b], one[a], other[a], units[a:b], spots[a:b], cells[a:b])
                    if len(x):
                        near = np.bincount(x, copies[a:b][y], b - a) + np.bincount(y, copies[a:b][x], b - a)
                        has = np.flatnonzero(near)
                        out.append(np.stack((node[a:b][has], near[has].astype(np.int64), node[a:b][_roots(b - a, x, y)[has]])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["node", "n_links", "root"])

        for batch in batches:
            held.append(batch)
            # The last group may go on in the next batch.
            rows = pa.concat_batches(held)
            last = np.all([(k := rows.column(n).to_numpy()) == k[-1] for n in _KEY], axis=0)
            if not last.all():
                cut = len(last) - int(last.sum())
                yield from solve(rows.slice(0, cut))
                held = [rows.slice(cut)]
        if held:
            yield from solve(pa.concat_batches(held))

    return tasks.mapInArrow(work, "node long, n_links long, root long")


def _valid(vector: Column) -> Column:
    """Finite components, at least one of them not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding, ...)``.

    Vectors link with a cosine of at least ``min_cosine``; a pair at the threshold is found with
    chance ``recall``, a nearer one with more, an equal one always. ``n_links`` counts other rows,
    repeated ones too. ``component_id`` is the smallest id reachable by links, itself included;
    ``kept`` tells that it is the row's own. A vector that is null, empty or zero, or holds null
    or non-finite components, links with nothing, and so do vectors of different length. A row
    with a null id takes part, has the component of its class (null in a class without ids) and
    is not kept. Other columns are ignored, whatever their names.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = rows.where(_valid(F.col("embedding"))).select(
        "vec_id", "embedding", F.xxhash64("embedding").alias("h"), F.xxhash64(F.reverse("embedding"), F.lit(1)).alias("g")
    )
    distinct = stored(
        usable.groupBy("h", "g")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    lines = lines_for(distinct.count(), min_cosine, recall)
    paired = _tasks(stored(_index(distinct, lines))).join(distinct.select("node", "copies", "embedding"), "node")
    ordered = paired.repartition(*_KEY).sortWithinPartitions(*_KEY)
    found = stored(_linked(ordered, lines, min_cosine))
    classes = stored(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    degrees = found.groupBy(F.col("node").alias("m")).agg(F.sum("n_links").alias("links"))
    known = stored(
        distinct.drop("embedding")
        .join(classes.withColumnRenamed("node", "c"), F.col("node") == F.col("c"), "left")
        .join(degrees, F.col("node") == F.col("m"), "left")
        .select("h", "g", "first_id", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    names = stored(known.groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = known.join(names, "root").select(
        F.col("h").alias("h2"), F.col("g").alias("g2"), "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    linked = usable.select("vec_id", "h", "g").join(named, (F.col("h") == F.col("h2")) & (F.col("g") == F.col("g2")))
    alone = rows.where(~_valid(F.col("embedding"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
