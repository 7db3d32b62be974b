"""Embedding near-duplicates by an exact metric range join.

On unit vectors a cosine of at least c is a distance of at most
eps = sqrt(2 - 2c). Pivots divide the vectors into cells (nearest pivot). Two
vectors within eps lie in one cell or, by the triangle inequality, the one of
the later cell lies within eps of the border to the earlier cell
((d(y,p)^2 - d(y,q)^2) / (2 d(p,q)) <= eps, p the earlier, q its own pivot) and
within eps of that cell's radius; there it is a visitor. Members meet members
and visitors. Pairs are found by a matrix product in single precision with a
margin and decided by their cosine in double precision.

Scale: equal vectors are one node with a count, known by the SHA-256 of their
components. Cells are cut into chunks of about ``cell_rows`` members, each one
row of a written table with its members as one matrix. Chunks meet in a
cartesian product of that table with itself, which reads its files again and
exchanges nothing: what is shuffled and written grows with the vectors, not with
the pairs. Chunks of which no row visits the other's cell do not meet. A task
holds one pair of chunks at a time and gives for each vector the number of its
links and the edges that join its labels - never the pairs. Pivots are a bounded
set (``max_pivots``). What limits the method is the data: where no coordinate is
far (independent directions in 64 dimensions), eps exceeds the distance to every
border, all chunks meet, and products and reads (not disk) grow with the square
of the distinct vectors.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components have no links; vectors of different lengths are never linked;
repeated rows are vectors of their own, linked to each other; a null id counts
as a link but is never a component id, unless all ids of the component are
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, task_count, write_and_read
from tidemart.llm.components import connected_components

CELL_ROWS = 2048
VISITOR_ROWS = 32768
TILE_ROWS = 2560
MARGIN = 1e-4
PACKED = "chunk long, cell int, size int, reach array<boolean>, u binary, n binary, x binary"
PACKED_ROWS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "1"}
"""A packed chunk is a row of half a megabyte at 64 dimensions; readers hold a row group at a time."""


def embedding_components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         min_cosine: float = 0.9, cell_rows: int = CELL_ROWS, visitor_rows: int = VISITOR_ROWS,
                         max_pivots: int = 4096, seed: int = 42) -> DataFrame:
    """id, n_links, component (smallest id reachable by links), kept: one row per input row.

    At most ``visitor_rows`` rows of a chunk meet those of another at once.
    """
    rows, kind = with_digest(df, id_col, vector_col, True)
    nodes = write_and_read(rows.where("h is not null").groupBy("h").agg(
        F.min("id__").alias("least"), F.count(F.lit(1)).alias("n"), F.first("x").alias("x")).withColumn(
        "u", F.monotonically_increasing_id()), "vectors")
    found = write_and_read(range_join(nodes.select("u", "n", "x"), kind, min_cosine, cell_rows, visitor_rows,
                                      max_pivots, seed), "vector-links")
    of_node = connected_components(found.where("u <> root").select(F.col("u").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("u").alias("x")).agg(F.sum("add").alias("more"))
    nodes = nodes.drop("x")
    named = nodes.join(links, F.col("u") == F.col("x"), "left").join(of_node, F.col("u") == F.col("node"), "left").select(
        F.col("h").alias("w"), "least", "n", F.coalesce("more", F.lit(0)).alias("more"),
        F.coalesce("component", "u").alias("root"))
    named = write_and_read(named, "vector-classes")
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component"))
    named = named.join(least, F.col("root") == F.col("r")).select("w", "component", (
        F.col("n") - 1 + F.col("more")).alias("n_links"))
    rows, _ = with_digest(df, id_col, vector_col, False)
    linked = rows.join(named, F.col("h") == F.col("w"), "left").withColumn(
        "component", F.when(F.col("w").isNull(), F.col("id__")).otherwise(F.col("component")))
    return linked.select(F.col("id__").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         "component", F.col("id__").eqNullSafe(F.col("component")).alias("kept"))


def with_digest(df: DataFrame, id_col: str, vector_col: str, data: bool) -> tuple[DataFrame, str]:
    """(id__, h: digest of the components, null where they can't be used, and x: the components where ``data``), their type.

    Floats stay floats, other numbers become doubles; zeros have no sign.
    """
    element = getattr(df.schema[vector_col].dataType, "elementType", None)
    name, kind = ("float", "<f4") if isinstance(element, T.FloatType) else ("double", "<f8")
    rows = df.select(F.col(id_col).alias("id__"), F.col(vector_col).cast(f"array<{name}>").alias("v__"))
    usable = F.exists("v__", lambda x: x != 0) & F.forall(
        "v__", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.withColumn("v__", F.when(F.coalesce(usable, F.lit(False)), F.col("v__")))
    schema = T.StructType([rows.schema["id__"], T.StructField("h", T.BinaryType())])
    return arrow_map(rows, lambda bs: digests(bs, kind, data), schema.add("x", "binary") if data else schema), kind


def digests(batches: Iterator[pa.RecordBatch], kind: str, data: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column("v__")
        raw = memoryview((v.flatten().to_numpy().astype(kind) + np.zeros(1, dtype=kind)).tobytes())
        stops = np.cumsum(pc.fill_null(pc.list_value_length(v), 0).to_numpy()) * np.dtype(kind).itemsize
        x = [raw[s:t] if good else None for s, t, good in zip([0, *stops.tolist()], stops.tolist(), v.is_valid().to_pylist())]
        out = [b.column("id__"), pa.array([None if r is None else hashlib.sha256(r).digest() for r in x], pa.binary())]
        if data:
            out.append(pa.array([None if r is None else bytes(r) for r in x], pa.binary()))
        yield pa.RecordBatch.from_arrays(out, names=["id__", "h", "x"][:len(out)])


def range_join(nodes: DataFrame, kind: str, min_cosine: float, cell_rows: int, visitor_rows: int, max_pivots: int,
               seed: int) -> DataFrame:
    """(u, add, root): links of u that one task found, and edges between nodes of one component.

    ``nodes`` has u, n (copies) and x (components as bytes of type ``kind``, all usable).
    """
    total = nodes.count()
    count = max(1, min(max_pivots, -(-total // cell_rows)))
    sample = nodes.orderBy(F.xxhash64(F.lit(seed), F.col("u")), "u").limit(4 * count).select("x").collect()
    pivots = spread_pivots([np.frombuffer(r["x"], kind).astype(float) for r in sample], count)
    eps = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    homes = write_and_read(arrow_map(nodes, lambda bs: assign(bs, kind, pivots), "u long, n long, cell int, d double, x binary"),
                           "vector-cells")
    cells = {r["cell"]: (r["rows"], r["far"]) for r in homes.groupBy("cell").agg(
        F.count(F.lit(1)).alias("rows"), F.max("d").alias("far")).collect()}
    chunks = np.array([-(-cells.get(c, (0, 0))[0] // cell_rows) for c in range(len(pivots) + 1)], dtype=np.int64)
    radius = np.array([cells.get(c, (0, -10.0))[1] for c in range(len(pivots) + 1)])
    bounds = Bounds(pivots, radius, eps + 1e-6)
    dealt = arrow_map(homes, lambda bs: deal(bs, chunks), "chunk long, cell int, u long, n long, x binary")
    dealt = dealt.repartition(task_count(nodes), "chunk").sortWithinPartitions("chunk")
    packed = write_and_read(arrow_map(dealt, lambda bs: pack(bs, kind, bounds), PACKED), "vector-chunks", PACKED_ROWS)
    met = packed.join(packed.select([F.col(c).alias(f"{c}_b") for c in packed.columns]).hint("shuffle_replicate_nl"), meets())
    return arrow_map(met.drop("reach", "reach_b"), lambda bs: join_chunks(bs, kind, bounds, min_cosine, visitor_rows),
                     "u long, add long, root long")


def meets() -> Column:
    """Which of (a, b) and (b, a) stands for a pair of chunks, by turns, and whether rows of one may visit the other's cell."""
    a, b, p, q = F.col("chunk"), F.col("chunk_b"), F.col("cell"), F.col("cell_b")
    one = (a == b) | ((a < b) != ((a + b) % 2 == 1))
    return (F.col("size") == F.col("size_b")) & one & (
        (p == q) | ((p < q) & F.get("reach_b", p)) | ((p > q) & F.get("reach", q)))


class Bounds:
    """Which rows of a cell may be within eps of a row of an earlier cell."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, slack: float):
        self.pivots, self.radius, self.slack = pivots, radius, slack

    def visits(self, x: np.ndarray, home: int, cells: slice) -> np.ndarray:
        """Rows of ``x`` (unit vectors of the cell ``home``) by ``cells``, all before it."""
        others, own = self.pivots[cells], self.pivots[home:home + 1]
        d = distances(x, others)
        gap = (d ** 2 - distances(x, own) ** 2) / (2 * np.maximum(distances(own, others), 1e-12))
        return (gap <= self.slack) & (d <= self.radius[cells] + self.slack)


def spread_pivots(sample: list[np.ndarray], count: int) -> np.ndarray:
    """Pivots of the most frequent length, each the farthest from those before; rows are unit vectors."""
    if not sample:
        return np.zeros((0, 1))
    lengths = [len(v) for v in sample]
    usual = max(sorted(set(lengths)), key=lengths.count)
    unit = unit_rows(np.array([v for v in sample if len(v) == usual]))
    pick, near = [0], np.full(len(unit), np.inf)
    while len(pick) < min(count, len(unit)):
        near = np.minimum(near, 2 - 2 * unit @ unit[pick[-1]])
        k = int(near.argmax())
        if near[k] <= 1e-9:
            break
        pick.append(k)
    return unit[pick]


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that huge or tiny components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * x @ pivots.T))


def assign(batches: Iterator[pa.RecordBatch], kind: str, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Nearest pivot and distance; vectors of another length share the last cell."""
    for b in batches:
        if not b.num_rows:
            continue
        cell, dist = np.full(b.num_rows, len(pivots), dtype=np.int32), np.zeros(b.num_rows)
        raw = b.column("x").to_pylist()
        usual = pivots.shape[1] * np.dtype(kind).itemsize
        at = np.flatnonzero(np.array([len(r) == usual for r in raw]))
        if len(at) and len(pivots):
            d = distances(units(b"".join(raw[i] for i in at.tolist()), kind, pivots.shape[1]), pivots)
            cell[at], dist[at] = d.argmin(axis=1), d.min(axis=1)
        yield pa.RecordBatch.from_arrays([b.column("u"), b.column("n"), pa.array(cell), pa.array(dist), b.column("x")],
                                         names=["u", "n", "cell", "d", "x"])


def units(data: bytes, kind: str, size: int) -> np.ndarray:
    return unit_rows(np.frombuffer(data, kind).reshape(-1, size).astype(float))


def deal(batches: Iterator[pa.RecordBatch], chunks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each vector's chunk of its cell."""
    first = np.r_[0, np.cumsum(chunks)]  # chunks are numbered through
    for b in batches:
        u, cell = b.column("u").to_numpy(), b.column("cell").to_numpy()
        mixed = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        chunk = first[cell] + (mixed % chunks[cell].astype(np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(chunk), *(b.column(c) for c in ("cell", "u", "n", "x"))],
                                         names=["chunk", "cell", "u", "n", "x"])


def pack(batches: Iterator[pa.RecordBatch], kind: str, bounds: Bounds) -> Iterator[pa.RecordBatch]:
    """A row per chunk (and length of vectors), with the earlier cells that its rows may visit."""
    def row(chunk: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = parts[0].column("cell")[0].as_py()
        u, n = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("u", "n"))
        raw = [x for p in parts for x in p.column("x").to_pylist()]
        lengths = np.array([len(x) for x in raw])
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            data, size = b"".join(raw[i] for i in at.tolist()), length // np.dtype(kind).itemsize
            reach = np.zeros(0, dtype=bool)
            if cell < len(bounds.pivots):
                reach = bounds.visits(units(data, kind, size), cell, slice(0, cell)).any(axis=0)
            yield pa.RecordBatch.from_pylist([{
                "chunk": chunk, "cell": cell, "size": size, "reach": reach.tolist(), "u": u[at].tobytes(),
                "n": n[at].tobytes(), "x": data}], schema=pa.schema([
                    ("chunk", pa.int64()), ("cell", pa.int32()), ("size", pa.int32()), ("reach", pa.list_(pa.bool_())),
                    ("u", pa.binary()), ("n", pa.binary()), ("x", pa.binary())]))

    parts: list[pa.RecordBatch] = []
    current = None
    for b in batches:
        at = 0
        for chunk, run in groupby(b.column("chunk").to_pylist()):
            k = sum(1 for _ in run)
            if chunk != current and parts:
                yield from row(current, parts)
                parts = []
            current = chunk
            parts.append(b.slice(at, k))
            at += k
    if parts:
        yield from row(current, parts)


class Side:
    """A chunk as one side of a comparison."""

    def __init__(self, b: pa.RecordBatch, i: int, kind: str, mark: str = ""):
        self.key = tuple(b.column(c + mark)[i].as_py() for c in ("chunk", "size"))
        self.cell = b.column("cell" + mark)[i].as_py()
        self.u, self.n = (np.frombuffer(b.column(c + mark)[i].as_buffer(), np.int64).copy() for c in "un")
        self.x = units(b.column("x" + mark)[i].as_buffer(), kind, self.key[1])
        self.low = self.x.astype(np.float32)


class Found:
    """What a task knows of a chunk's vectors: links so far, and the smallest node met of each one's component."""

    def __init__(self, u: np.ndarray):
        self.u, self.add, self.label = u, np.zeros(len(u), dtype=np.int64), u.copy()


def join_chunks(batches: Iterator[pa.RecordBatch], kind: str, bounds: Bounds, min_cosine: float,
                visitor_rows: int) -> Iterator[pa.RecordBatch]:
    """Edges as they are found, sums of links at the end of the task."""
    found: dict[tuple[int, int], Found] = {}
    a = None
    for batch in batches:
        for i in range(batch.num_rows):
            if a is None or a.key != (batch.column("chunk")[i].as_py(), batch.column("size")[i].as_py()):
                a = Side(batch, i, kind)
            b = Side(batch, i, kind, "_b")
            fa, fb = (found.setdefault(s.key, Found(s.u)) for s in (a, b))
            rows = [np.arange(len(a.u)), np.arange(len(b.u))]
            if a.cell != b.cell:  # visitors are of the later cell
                k, later, p = (0, a, b.cell) if a.cell > b.cell else (1, b, a.cell)
                rows[k] = np.flatnonzero(bounds.visits(later.x, later.cell, slice(p, p + 1))[:, 0])
            yield from compare(a, b, *rows, fa, fb, min_cosine, min(visitor_rows, TILE_ROWS))
    for f in found.values():
        at = np.flatnonzero(f.add)
        if len(at):
            yield links(f.u[at], f.add[at], f.u[at])


def links(u: np.ndarray, add: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(add), pa.array(root)], names=["u", "add", "root"])


def compare(a: Side, b: Side, left: np.ndarray, right: np.ndarray, fa: Found, fb: Found, min_cosine: float,
            step: int) -> Iterator[pa.RecordBatch]:
    """Links between rows ``left`` of ``a`` and ``right`` of ``b``, or among those of one chunk."""
    same = a.key == b.key
    for s in range(0, len(left), step):
        r0 = left[s:s + step]
        for t in range(s if same else 0, len(right), step):
            c0 = right[t:t + step]
            hit = a.low[r0] @ b.low[c0].T >= min_cosine - MARGIN
            if same and s == t:
                hit = np.triu(hit, 1)
            r, c = np.nonzero(hit)
            if not len(r):
                continue
            for i in range(0, len(r), 1 << 18):  # decided in double precision
                k = slice(i, i + (1 << 18))
                cos = np.einsum("ij,ij->i", a.x[r0[r[k]]], b.x[c0[c[k]]])
                hit[r[k], c[k]] = cos >= min_cosine
            yield from settle(hit, r0, c0, a.n, b.n, fa, fb)


def settle(hit: np.ndarray, r0: np.ndarray, c0: np.ndarray, n: np.ndarray, m: np.ndarray, fa: Found,
           fb: Found) -> Iterator[pa.RecordBatch]:
    """Counts the links of a tile and gives its vectors the smallest label that they reach in it.

    Every change of a label is an edge, once for a tile: a vector's labels, itself
    the first, are so joined, and the two ends of a link have one label in common.
    """
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    if not len(rows):
        return
    hit, rows, cols = hit[np.ix_(rows, cols)], r0[rows], c0[cols]
    fa.add[rows] += hit @ m[cols]
    fb.add[cols] += n[rows] @ hit
    top = np.iinfo(np.int64).max
    before = fa.label[rows], fb.label[cols]
    left, right = before
    while True:  # smallest label reachable inside the tile
        r = np.minimum(right, np.where(hit, left[:, None], top).min(axis=0))
        l = np.minimum(left, np.where(hit, r[None, :], top).min(axis=1))
        if (l == left).all() and (r == right).all():
            break
        left, right = l, r
    fa.label[rows] = left
    fb.label[cols] = np.minimum(fb.label[cols], right)
    edges = np.stack([np.concatenate(before), np.concatenate([left, right])], axis=1)
    edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
    if len(edges):
        yield links(edges[:, 0], np.zeros(len(edges), dtype=np.int64), edges[:, 1])
