"""Exact near-duplicate vectors by dual traversal of cover trees.

A cover tree has nested levels whose radii halve; every node covers the vectors below it within a known radius. Two
nodes whose centres are further apart than both radii and the threshold together hold no link and are pruned. The
upper part of the tree is fitted on a bounded sample and only decides where vectors go: all radii are taken over all
vectors, so pruning is exact whatever the sample. The lower part is built in each task, over blocks of bounded size.

Vectors are written once, in chunks of whole cells. Pairs of chunks meet by reading those files again, never by a
shuffle, so what is written grows with the vectors and not with the pairs.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import connected_components, map_batches
from riskmill.sources.workspace import stage

BLOCK = 2048
SAMPLE = 4096  # at least; four for each cell, if they fit SAMPLE_BYTES in double precision
SAMPLE_BYTES = 64 << 20
MAX_CELLS = 4096
CHUNK_BYTES = 16 << 20  # of vectors in single precision
CHUNKS = 16  # at least, if they don't get smaller than a block
HELD = 8  # chunks kept decoded in a task, and chunks in a task's part of either side
HEAD = 16  # components that bound a cosine, with the length of the others
LEAF = 32
SLACK = 1e-6  # of distances, far above rounding errors


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length 1."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def chord(cosines: np.ndarray) -> np.ndarray:
    """Distance of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


def arc(distance):
    """Angle between unit vectors of this distance; angles give the sharper triangle inequality."""
    return 2.0 * np.arcsin(np.clip(distance, 0.0, 2.0) / 2.0)


def rounding(dimension: int) -> float:
    """More than cosines in single precision can be off."""
    return max(1e-5, dimension * 2.4e-7)


# --- The lower tree: in a task ------------------------------------------------------------------------


@dataclass
class Node:
    members: np.ndarray
    center: np.ndarray
    radius: float
    children: list[Node] = field(default_factory=list)


def cover_tree(vectors: np.ndarray, members: np.ndarray | None = None, scale: float = 2.0) -> Node:
    """Nested levels with halving radii; a node whose next level would have too many children is a leaf."""
    members = np.arange(len(vectors)) if members is None else members
    own = vectors[members]
    center = own[0]
    node = Node(members, center, float(chord(own @ center).max()))
    if len(members) <= LEAF:
        return node
    scale = min(scale, node.radius) / 2
    if scale < 1e-4 or len(own) > 16 * LEAF and _owners(own[:: len(own) // (8 * LEAF)], scale) is None:
        return node
    owner = _owners(own, scale)
    if owner is None:
        return node
    centers = int(owner.max()) + 1
    if centers > 1:
        node.children = [cover_tree(vectors, members[owner == k], scale) for k in range(centers) if (owner == k).any()]
    return node


def _owners(own: np.ndarray, scale: float) -> np.ndarray | None:
    """The nearest of centres in farthest-first order, as many as cover all within ``scale``; None for more than LEAF."""
    nearest, owner, centers = np.full(len(own), np.inf), np.zeros(len(own), np.int64), 0
    while nearest.max() > scale:
        if centers == LEAF:
            return None
        far = int(nearest.argmax())
        distance = chord(own @ own[far])
        closer = distance < nearest
        nearest[closer], owner[closer] = distance[closer], centers
        centers += 1
    return owner


def _head(rows: np.ndarray) -> np.ndarray:
    return np.column_stack([rows[:, :HEAD], np.linalg.norm(rows[:, HEAD:], axis=1)])


def _above(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows whose cosine in single precision is ``least`` or more, and these cosines."""
    if x.shape[1] > 2 * HEAD:
        bound = _head(x) @ _head(y).T  # never below the cosine, as the others' product is at most that of their lengths
        if not bound.size or bound.max() < least:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        some = np.flatnonzero(bound >= least)
        if len(some) <= bound.size // 64:
            i, j = np.divmod(some, len(y))
            cosines = np.einsum("ij,ij->i", x[i], y[j])
            good = cosines >= least
            return i[good], j[good], cosines[good]
    cosines = (x @ y.T).ravel()
    some = np.flatnonzero(cosines >= least)
    return *np.divmod(some, max(1, len(y))), cosines[some]


def linked(
    a: np.ndarray,
    b: np.ndarray,
    one: Node,
    other: Node,
    cosine: float,
    keep: tuple[np.ndarray, np.ndarray] | None = None,
    exact: tuple[Callable, Callable] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``a`` and ``b`` with at least this cosine: dual traversal from two roots.

    Rows that ``keep`` leaves out are passed over. ``exact`` gives rows in double precision if ``a`` and ``b`` aren't;
    only cosines too near the limit for single precision are taken from these.
    """
    limit, todo, near = float(arc(math.sqrt(2 - 2 * cosine))) + SLACK, [(one, other)], rounding(a.shape[1])
    rows_a, rows_b = exact or (a.__getitem__, b.__getitem__)
    while todo:
        x, y = todo.pop()
        if float(arc(chord(x.center @ y.center))) - float(arc(x.radius)) - float(arc(y.radius)) > limit:
            continue
        if not x.children and not y.children:
            of_x, of_y = x.members, y.members
            if keep is not None:
                of_x, of_y = of_x[keep[0][of_x]], of_y[keep[1][of_y]]
            narrow = (rows.astype(np.float32, copy=False) for rows in (a[of_x], b[of_y]))
            i, j, rough = _above(*narrow, cosine - near)
            if not len(i):
                continue
            good = rough >= cosine + near
            i, j = of_x[i], of_y[j]
            open_ = np.flatnonzero(~good)
            for k in range(0, len(open_), 65_536):
                part = open_[k : k + 65_536]
                good[part] = np.einsum("ij,ij->i", rows_a(i[part]), rows_b(j[part])) >= cosine
            yield i[good], j[good]
        elif x.children and (not y.children or x.radius >= y.radius):
            todo += [(child, y) for child in x.children]
        else:
            todo += [(x, child) for child in y.children]


class Chunk:
    """Vectors of neighbouring cells, by cell and distance from its centre, in pieces of one cell each."""

    def __init__(self, raw, sizes, cell, start, reach, centers):
        self.raw, self.sizes, self.reach = raw, sizes, reach
        self.unit = np.concatenate([unit(raw[k : k + BLOCK]).astype(np.float32) for k in range(0, len(raw), BLOCK)])
        self.ends = list(zip(start.tolist(), [*start[1:].tolist(), len(raw)]))
        self.centers = centers[cell].astype(np.float32)
        self.trees: dict[int, Node] = {}

    def tree(self, k: int) -> Node:
        if k not in self.trees:
            self.trees[k] = cover_tree(unit(self.raw[slice(*self.ends[k])]))
        return self.trees[k]

    def exact(self, k: int) -> Callable:
        first = self.ends[k][0]
        return lambda rows: unit(self.raw[first + rows])

    def near(self, pieces: slice, rows: np.ndarray, angle: float) -> np.ndarray:
        """For each of the pieces, the rows that may be within the angle of one of its vectors."""
        least = np.cos(np.minimum(np.pi, self.reach[pieces] + angle)) - rounding(rows.shape[1])
        return self.centers[pieces] @ rows.T >= least[:, None].astype(np.float32)


def chunk_links(a: Chunk, b: Chunk, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of both chunks with at least this cosine; of a chunk with itself, each pair once."""
    angle = float(arc(math.sqrt(2 - 2 * cosine))) + SLACK
    starts = [first for first, _ in b.ends]
    for x, (first_a, end_a) in enumerate(a.ends):
        of_a = b.near(slice(None), a.unit[first_a:end_a], angle)
        of_b = a.near(slice(x, x + 1), b.unit, angle)[0]
        for y in np.flatnonzero(of_a.any(axis=1) & np.logical_or.reduceat(of_b, starts)).tolist():
            if a is b and y < x:
                continue
            first_b, end_b = b.ends[y]
            keep, exact = (of_a[y], of_b[first_b:end_b]), (a.exact(x), b.exact(y))
            blocks = a.unit[first_a:end_a], b.unit[first_b:end_b]
            for i, j in linked(*blocks, a.tree(x), b.tree(y), cosine, keep, exact):
                if a is b and x == y:
                    i, j = i[i < j], j[i < j]
                yield i + first_a, j + first_b


class Links:
    """Number of vectors linked to each one, and the first of its component, over several pairs of chunks."""

    def __init__(self):
        self.first: dict[int, int] = {}
        self.links, self.root = np.empty(0, np.int64), np.empty(0, np.int64)

    def place(self, number: int, chunk: Chunk) -> int:
        if number not in self.first:
            self.first[number] = known = len(self.root)
            self.links = np.concatenate([self.links, np.zeros(len(chunk.sizes), np.int64)])
            self.root = np.concatenate([self.root, np.arange(known, known + len(chunk.sizes))])
        return self.first[number]

    def add(self, number_a: int, a: Chunk, number_b: int, b: Chunk, cosine: float) -> None:
        at_a, at_b = self.place(number_a, a), self.place(number_b, b)
        open_, count = [], 0
        for i, j in chunk_links(a, b, cosine):
            np.add.at(self.links, i + at_a, b.sizes[j])
            np.add.at(self.links, j + at_b, a.sizes[i])
            i, j = i + at_a, j + at_b
            apart = self.root[i] != self.root[j]
            open_.append((i[apart], j[apart]))
            count += len(open_[-1][0])
            if count > 1_000_000:
                self.join(open_)
                open_, count = [], 0
        self.join(open_)

    def join(self, edges: list[tuple[np.ndarray, np.ndarray]]) -> None:
        i, j = (np.concatenate([e[k] for e in edges] or [np.empty(0, np.int64)]) for k in (0, 1))
        while len(i):
            one, other = self.root[i], self.root[j]
            apart = one != other
            i, j, one, other = i[apart], j[apart], one[apart], other[apart]
            np.minimum.at(self.root, np.maximum(one, other), np.minimum(one, other))
            while not np.array_equal(new := self.root[self.root], self.root):
                self.root = new

    def found(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of linked vectors (``chunk`` * 2**32 + place), their links and the number of their component's first."""
        number = np.empty(len(self.root), np.int64)
        ends = [*list(self.first.values())[1:], len(self.root)]
        for (chunk, first), end in zip(self.first.items(), ends):
            number[first:end] = (chunk << 32) + np.arange(end - first)
        for first, end in zip(self.first.values(), ends):
            some = first + np.flatnonzero(self.links[first:end])
            yield number[some], self.links[some], number[self.root[some]]


# --- The upper tree: cells ----------------------------------------------------------------------------


class Cells:
    """Centres chosen by farthest-first order, whose prefixes are nested nets: a centre's level is the halving of
    the radius at which it was added, its parent the nearest centre of the levels above."""

    def __init__(self, sample: np.ndarray, count: int, least: float = 0.0):
        distance, chosen, added = np.full(len(sample), 2.0), [], []
        for _ in range(min(count, len(sample))):
            far = int(distance.argmax())
            if chosen and distance[far] <= least:
                break
            added.append(float(distance[far]))
            chosen.append(far)
            distance = np.minimum(distance, chord(sample @ sample[far]))
        self.centers = sample[chosen]
        self.levels = [0 if k == 0 else 1 + max(0, int(-math.log2(r / 2))) for k, r in enumerate(added)]
        self.parents = [-1]
        for k in range(1, len(chosen)):
            above = self.centers[: bisect_left(self.levels, self.levels[k])]  # levels never fall
            self.parents.append(int((above @ self.centers[k]).argmax()))

    def order(self) -> list[int]:
        """All cells, each before those below it, which follow at once."""
        children: list[list[int]] = [[] for _ in self.parents]
        for k in range(len(self.parents) - 1, 0, -1):
            children[self.parents[k]].append(k)
        found, todo = [], [0]
        while todo:
            found.append(todo.pop())
            todo += children[found[-1]]
        return found

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centre and its distance. Equal vectors get the same one wherever they stand: a product of
        matrices rounds by their shapes, so centres that it can't tell apart are compared vector by vector."""
        narrow, near = self.centers.astype(np.float32).T, 4 * rounding(self.centers.shape[1])
        cell = np.empty(len(vectors), np.int64)
        for k in range(0, len(vectors), BLOCK):
            part = vectors[k : k + BLOCK]
            cosines = part.astype(np.float32) @ narrow
            first = cosines.argmax(axis=1)
            close = cosines >= cosines[np.arange(len(part)), first][:, None] - near
            several = np.flatnonzero(np.count_nonzero(close, axis=1) > 1)
            row, center = np.nonzero(close[several])
            exact = np.empty(len(row))
            for m in range(0, len(row), 65_536):
                some = slice(m, m + 65_536)
                exact[some] = np.einsum("ij,ij->i", part[several[row[some]]], self.centers[center[some]])
            best = np.lexsort((center, -exact, row))
            first[several] = center[best[np.flatnonzero(np.diff(row[best], prepend=-1))]]
            cell[k : k + BLOCK] = first
        return cell, chord(np.einsum("ij,ij->i", vectors, self.centers[cell]))

    def meeting(self, cells: np.ndarray, radius: dict[int, float], limit: float) -> Iterator[np.ndarray]:
        """For each of the cells, whether it may hold a link with each of them."""
        centers, angle = self.centers[cells], float(arc(limit)) + SLACK
        reach = np.array([float(arc(radius[k])) for k in cells.tolist()])
        for k in range(len(cells)):
            yield arc(chord(centers @ centers[k])) - reach - reach[k] <= angle

    def pairs(self, radius: dict[int, float], limit: float) -> list[tuple[int, int]]:
        """Pairs of cells that may hold a link, each cell with itself included."""
        cells = np.array(sorted(radius))
        rows = self.meeting(cells, radius, limit)
        return [(int(x), int(y)) for k, (x, row) in enumerate(zip(cells, rows)) for y in cells[k:][row[k:]]]


class Layout:
    """The chunk of each cell: neighbours share one, and a cell of more vectors than a chunk has several."""

    def __init__(self, cells: Cells, sizes: dict[int, int], radius: dict[int, float], limit: float, rows: int):
        self.base, self.parts = np.zeros(len(cells.centers), np.int64), np.ones(len(cells.centers), np.int64)
        order, starts, parts, room = [k for k in cells.order() if k in sizes], [], [], 0
        for place, k in enumerate(order):
            self.parts[k] = -(-sizes[k] // rows)
            if not parts or sizes[k] > room:
                starts.append(place)
                parts.append(int(self.parts[k]))
                room = rows if self.parts[k] == 1 else 0
            room -= min(room, sizes[k])
            self.base[k] = sum(parts[:-1])
        rows_met = cells.meeting(np.array(order), radius, limit)
        meet = np.zeros((len(starts), len(starts)), bool)
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(order)]))
        for g, row in zip(group, rows_met):
            meet[g] |= np.logical_or.reduceat(row, starts)
        meet = meet.repeat(parts, axis=0).repeat(parts, axis=1)
        one, other = np.indices(meet.shape, np.int32, sparse=True)
        first = np.where((one + other) % 2 == 0, one <= other, one > other)  # each pair once, evenly over all chunks
        self.partners = [np.flatnonzero(row).astype(np.int32) for row in meet & first]

    def chunk(self, cell: np.ndarray, name: np.ndarray) -> np.ndarray:
        return self.base[cell] + name % self.parts[cell]


# --- The operator -------------------------------------------------------------------------------------

USABLE = """embedding IS NOT NULL AND size(embedding) > 0
    AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
    AND exists(embedding, x -> x != 0)"""


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    width = rows.shape[1] * rows.itemsize
    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
    buffers = [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(rows))]
    return pa.Array.from_buffers(pa.binary(), len(rows), buffers)


def _once(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Table]:
    """First places of the batch's different vectors; their names, numbers of rows and least ids."""
    table = pa.table({c: batch.column(c) for c in ("h1", "h2", "vec_id")} | {"place": pa.array(np.arange(batch.num_rows))})
    groups = table.group_by(["h1", "h2"], use_threads=False)
    table = groups.aggregate([("place", "min"), ("place", "count"), ("vec_id", "min")])
    return table["place_min"].to_numpy(), table


BLOBS = """chunk int, partners array<int>, vectors binary, cell array<int>, start array<int>, reach array<double>,
    n array<bigint>, rep array<bigint>, h1 array<bigint>, h2 array<bigint>"""
NAMES = [field.split()[0] for field in BLOBS.split(",")]


def _chunks_of_dimension(
    named: DataFrame, dimension: int, n: int, cosine: float, block: int, first: int
) -> tuple[DataFrame, DataFrame, int]:
    """The different vectors of one length in chunks, numbered from ``first``; id, links, root; the next chunk's number."""
    rows = named.filter(F.size("embedding") == dimension)
    kind = np.float32 if rows.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    count = min(MAX_CELLS, -(-n // block))
    size = max(SAMPLE, min(4 * count, SAMPLE_BYTES // (8 * dimension)))
    share = min(1.0, size / n)
    picked = rows.filter(F.pmod(F.xxhash64("h1"), F.lit(1_000_000)) <= int(share * 1_000_000))
    picked = picked.select("h1", "embedding").dropDuplicates(["h1"]).select("embedding")
    sample = picked.limit(2 * size).toArrow()  # about size; the limit only bounds the driver
    if not sample.num_rows:
        sample = rows.select("embedding").limit(1).toArrow()
    limit = math.sqrt(2 - 2 * cosine)
    cells = Cells(unit(_matrix(sample["embedding"].combine_chunks())), count, limit / 8)  # closer cells prune no more
    context = named.sparkSession.sparkContext
    shared = context.broadcast(cells)

    def place(batch: pa.RecordBatch) -> dict:
        names = ["cell", "distance", "h1"]
        if not batch.num_rows:
            return dict(zip(names, (pa.array([], t) for t in (pa.int32(), pa.float64(), pa.int64()))))
        cell, distance = shared.value.nearest(unit(_matrix(batch.column("embedding"))))
        return {"cell": pa.array(cell.astype(np.int32)), "distance": pa.array(distance), "h1": batch.column("h1")}

    placed = map_batches(rows.select("h1", "embedding"), place, "cell int, distance double, h1 bigint")
    sizes = (F.max("distance").alias("radius"), F.approx_count_distinct("h1").alias("n"))
    per_cell = placed.groupBy("cell").agg(*sizes).collect()
    chunk_rows = max(1, min(CHUNK_BYTES // (4 * dimension), max(block, -(-n // CHUNKS))))
    counts, radius = {r["cell"]: max(1, r["n"]) for r in per_cell}, {r["cell"]: r["radius"] for r in per_cell}
    layout = Layout(cells, counts, radius, limit, chunk_rows)
    shared_layout = context.broadcast(layout)
    fields = "chunk int, cell int, distance double, h1 bigint, h2 bigint, n bigint, rep bigint, vector binary"

    def deal(batch: pa.RecordBatch) -> dict:
        at, table = _once(batch)
        raw, cell, distance = np.empty((0, dimension), kind), np.empty(0, np.int64), np.empty(0)
        if len(at):
            raw = _matrix(batch.column("embedding").take(pa.array(at))).astype(kind, copy=False)
            cell, distance = shared.value.nearest(unit(raw))
        chunk = shared_layout.value.chunk(cell, table["h2"].to_numpy())
        names = {"h1": "h1", "h2": "h2", "n": "place_count", "rep": "vec_id_min"}
        return {k: table[v].combine_chunks() for k, v in names.items()} | {
            "chunk": pa.array(chunk.astype(np.int32)), "cell": pa.array(cell.astype(np.int32)),
            "distance": pa.array(distance), "vector": _binary(raw),
        }

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("distance", "ascending")]).combine_chunks()
        cell, chunk = table["cell"].to_numpy(), table["chunk"][0].as_py()
        new = np.flatnonzero(np.diff(cell, prepend=-1))
        start = np.concatenate([np.arange(x, y, block) for x, y in zip(new, [*new[1:], len(cell)])])
        reach = arc(table["distance"].to_numpy()[np.append(start[1:], len(cell)) - 1]) + SLACK
        vector = table["vector"].combine_chunks()
        ends = np.frombuffer(vector.buffers()[1], np.int32)[vector.offset : vector.offset + len(vector) + 1].tolist()
        blob = vector.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes()
        lists = {c: table[c].combine_chunks() for c in ("n", "rep", "h1", "h2")}
        lists |= {"cell": pa.array(cell[start]), "start": pa.array(start.astype(np.int32)), "reach": pa.array(reach)}
        lists |= {"partners": pa.array(first + shared_layout.value.partners[chunk])}
        columns = {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in lists.items()}
        columns |= {"chunk": pa.array([first + chunk], pa.int32()), "vectors": pa.array([blob], pa.binary())}
        return pa.table({k: columns[k] for k in NAMES})

    dealt = map_batches(rows, deal, fields).repartition(len(layout.partners), "chunk")
    classes = dealt.groupBy("chunk", "h1", "h2").agg(
        F.sum("n").alias("n"), F.min("rep").alias("rep"), *(F.first(c).alias(c) for c in ("cell", "distance", "vector"))
    )
    chunks = stage(classes.groupBy("chunk").applyInArrow(pack, BLOBS), "vector-chunks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = Links(), OrderedDict()
        for batch in batches:
            for k in range(batch.num_rows):
                pair = []
                for side in ("left", "right"):
                    row = batch.column(side)[k]
                    number = row["chunk"].as_py()
                    if number not in held:
                        raw = np.frombuffer(row["vectors"].as_buffer(), kind).reshape(-1, dimension).copy()
                        lists = [row[c].values.to_numpy(zero_copy_only=False) for c in ("n", "cell", "start", "reach")]
                        held[number] = Chunk(raw, *lists, shared.value.centers)
                    held.move_to_end(number)
                    pair += [number, held[number]]
                while len(held) > HELD:
                    held.popitem(last=False)
                total.add(*pair, cosine)
        for columns in total.found():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "links", "root"])

    read = [F.struct("chunk", "vectors", "n", "cell", "start", "reach").alias(side) for side in ("left", "right")]
    parts = max(HELD, -(-len(layout.partners) // HELD), math.isqrt(4 * context.defaultParallelism))
    sides = chunks.coalesce(parts)  # a task for each two of them
    pairs = sides.select(read[0], "partners").hint("shuffle_replicate_nl").join(
        sides.select(read[1], F.col("chunk").alias("other")), F.array_contains("partners", F.col("other"))
    )
    found = pairs.select("left", "right").mapInArrow(compare, "id bigint, links bigint, root bigint")
    return chunks, found, first + len(layout.partners)


def embedding_duplicates(vectors: DataFrame, cosine: float = 0.95, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector.

    Equal vectors form a class and are compared once. Classes go to cells, and cells to chunks, each stored as one
    row. Pairs of chunks that the radii don't rule out are compared in tasks that read both from storage; inside,
    only vectors within reach of the other's cell are. A task returns numbers of links and the components inside it,
    never pairs, so thousands of near copies cost one row each. Cosines are compared in double precision.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing, nor do vectors
    of different lengths. Repeated rows are vectors of their own; NULL ids are allowed, and a group of NULL ids
    only has a NULL component_id. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    usable = F.coalesce(F.expr(USABLE), F.lit(False))
    named = rows.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"))
    hashes = {"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")}
    named = named.withColumns({k: F.when(F.col("embedding").isNotNull(), v) for k, v in hashes.items()})
    kept = named.filter("h1 IS NOT NULL")
    if vectors.schema["embedding"].dataType.elementType.typeName() != "float":
        kept = kept.withColumn("embedding", F.col("embedding").cast("array<double>"))
    dimensions = kept.groupBy(F.size("embedding").alias("d")).agg(F.approx_count_distinct("h1").alias("n")).collect()
    result = named.select("vec_id", "h1", "h2")
    if not dimensions:
        return result.select(
            "vec_id",
            F.lit(0).cast("bigint").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    found, member, first = None, None, 0
    for r in sorted(dimensions):
        chunks, part, first = _chunks_of_dimension(kept, r["d"], max(1, r["n"]), cosine, block, first)
        each = chunks.select("chunk", F.posexplode(F.arrays_zip("h1", "h2", "n", "rep")).alias("place", "c"))
        each = each.select((F.shiftleft(F.col("chunk").cast("bigint"), 32) + F.col("place")).alias("id"), "c.*")
        found = part if found is None else found.unionByName(part)
        member = each if member is None else member.unionByName(each)
    found = stage(found, "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-groups")
    linked_ones = links.join(groups, F.col("id") == F.col("node"), "left").select("id", "links", "component")
    member = member.join(linked_ones, "id", "left").filter("links IS NOT NULL OR n > 1")  # of any other vector, its own id
    member = member.withColumn("group", F.coalesce("component", "id"))
    smallest = member.groupBy("group").agg(F.min("rep").alias("component_id"))
    member = member.join(smallest, "group").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id"
    )
    result = result.join(member, ["h1", "h2"], "left")
    component_id = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(component_id).alias("kept"),
    )
