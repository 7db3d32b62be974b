"""Embedding whitening from a bit-sliced scatter matrix.

Every entry c becomes the integer x = floor(scale * c) + shift. Blocks of rows
are sliced: per dimension the smallest x of the block is subtracted, and bit b
of all rows is packed into 64-bit words, one plane per (dimension, bit). The
popcount of the AND of two planes counts rows in which both bits are set, so
the sum over planes of 2^(b+c) * popcount is the exact cross product of two
dimensions; subtracted minima are added back in integers. Blocks add up to n,
the sums S and the cross products T, and n*T - S*S' is n^2 times the covariance
V, centred before anything is rounded. V's eigenvectors (``numpy.linalg.eigh``)
give the components.

Scale: a task holds one block of rows, its planes and a D x D matrix; tasks are
added in Spark, and D * (D + 3) / 2 + 1 sums reach the driver, a bound by the
dimension alone. Rows are read twice (scatter, projection); the projected rows
are written once, because identity_error is measured on them.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are left out of the fit and of the result; so are vectors of another
length than the most frequent one (of equally frequent lengths the longest
counts). Entries beyond 2^52 / scale count as that bound. Components without
variance (an eigenvalue that is zero to double precision) project to 0, explain
what their eigenvalue says and take no part in identity_error; fewer dimensions
than components give so many components. Repeated rows and null ids are rows
like others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, write_and_read

BLOCK_ROWS = 8192
LIMB = 24
"""Bits of one virtual dimension: counts of a block times 2^(2 * LIMB) stay below 2^63."""
WORD = 36
LARGEST = float(1 << 52)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
           scale: int = 1024, shift: int = 100000) -> DataFrame:
    """id, component (from 1), n, deviation (decimal), whitened, explained, identity_error.

    One row per usable vector and component. ``deviation`` is the exact sum over
    dimensions of (n * x - S)^2.
    """
    rows = df.select(F.col(id_col).alias("id__"), F.col(vector_col).cast("array<double>").alias("v__")).where(
        usable(F.col("v__")))
    sizes = rows.groupBy(F.size("v__").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    rows = rows.where(F.size("v__") == size)
    n, sums, products = scatter(rows, size, scale, shift)
    kept = min(components, size)
    axes, values, trace = principal_axes(n, sums, products, kept)
    rank = int((values > values.max(initial=0.0) * size * np.finfo(float).eps).sum())
    gain = np.where(np.arange(kept) < rank, 1 / np.sqrt(np.maximum(values, np.finfo(float).tiny)), 0.0)
    schema = T.StructType([rows.schema["id__"]]).add("high", "long").add("low", "long").add("w", T.ArrayType(T.DoubleType()))
    placed = write_and_read(arrow_map(rows, lambda bs: project(bs, scale, shift, n, sums, axes * gain), schema), "whitened")
    error = identity_error(placed, n, rank)
    explained = values / trace if trace > 0 else np.zeros(kept)
    deviation = (F.col("high").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)")
                 + F.col("low").cast("decimal(19,0)")).cast("decimal(38,0)")
    out = placed.select(F.col("id__").alias(id_col), deviation.alias("deviation"), F.posexplode("w").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in explained]).cast("array<double>")
    return out.select(id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                      "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
                      F.lit(error).alias("identity_error"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all entries present and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def integers(batch: pa.RecordBatch, scale: int, shift: int) -> np.ndarray:
    """x of a batch, one row per vector."""
    flat = batch.column("v__").flatten().to_numpy(zero_copy_only=False)
    grid = np.floor(np.clip(flat, -LARGEST / scale, LARGEST / scale) * scale).astype(np.int64) + shift
    return grid.reshape(batch.num_rows, -1)


def scatter(rows: DataFrame, size: int, scale: int, shift: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums of x and the cross products of x, all exact."""
    if size == 0:
        return 0, [], []
    parts = arrow_map(rows, lambda bs: block_sums(bs, size, scale, shift),
                      "i int, j int, p0 long, p1 long, p2 long, p3 long")
    found = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("p0", "p1", "p2", "p3")]).collect()
    n, sums, products = 0, [0] * size, [[0] * size for _ in range(size)]
    for r in found:
        i, j, value = r["i"], r["j"], sum(r[f"p{k}"] << (WORD * k) for k in range(4))
        if i < 0:
            n = value
        elif j < 0:
            sums[i] = value
        else:
            products[i][j] = products[j][i] = value
    return n, sums, products


def block_sums(batches: Iterator[pa.RecordBatch], size: int, scale: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Sums of one task: (-1, -1) n, (i, -1) the sum of x_i, (i, j) the cross product, in words of 36 bits."""
    n, sums, products = 0, np.zeros(size, dtype=object), np.zeros((size, size), dtype=object)
    held: list[np.ndarray] = []

    def add() -> None:
        nonlocal n, sums, products
        x = np.concatenate(held)
        held.clear()
        for s in range(0, len(x), BLOCK_ROWS):
            least, y_sums, y_products = sliced_products(x[s:s + BLOCK_ROWS])
            m, k = least.astype(object), len(x[s:s + BLOCK_ROWS])
            n += k
            sums = sums + y_sums + k * m
            products = products + y_products + np.outer(m, y_sums) + np.outer(y_sums, m) + k * np.outer(m, m)

    for b in batches:
        if b.num_rows:
            held.append(integers(b, scale, shift))
            if sum(map(len, held)) >= BLOCK_ROWS:
                add()
    if held:
        add()
    if n == 0:
        return
    i, j = np.triu_indices(size)
    at = [(-1, -1), *((k, -1) for k in range(size)), *zip(i.tolist(), j.tolist())]
    values = [n, *sums.tolist(), *products[i, j].tolist()]
    low = (1 << WORD) - 1
    words = [[v & low for v in values], [v >> WORD & low for v in values], [v >> 2 * WORD & low for v in values],
             [v >> 3 * WORD for v in values]]
    yield pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in at], pa.int32()), pa.array([b for _, b in at], pa.int32()),
         *[pa.array(w, pa.int64()) for w in words]], names=["i", "j", "p0", "p1", "p2", "p3"])


def sliced_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minima m, sums of x - m, cross products of x - m) of one block, from AND-popcounts of its bit planes."""
    least = x.min(axis=0)
    y = (x - least).T.astype(np.uint64)
    planes, owner, bit = [], [], []
    for d, top in enumerate(y.max(axis=1).tolist()):
        for b in range(int(top).bit_length()):
            planes.append((y[d] >> np.uint64(b) & np.uint64(1)).astype(bool))
            owner.append(d)
            bit.append(b)
    size = len(least)
    sums, products = np.zeros(size, dtype=object), np.zeros((size, size), dtype=object)
    if not planes:
        return least, sums, products
    packed = np.packbits(np.array(planes), axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
    both = np.zeros((len(packed), len(packed)), dtype=np.int64)
    for k, plane in enumerate(packed):
        both[k, k:] = both[k:, k] = np.bitwise_count(packed[k:] & plane).sum(axis=1, dtype=np.int64)
    # planes of LIMB neighbouring bits of a dimension form one virtual dimension
    owner, bit = np.array(owner), np.array(bit)
    first = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (np.diff(bit // LIMB) != 0)])
    weight = np.int64(1) << (bit % LIMB)
    virtual = np.add.reduceat(np.add.reduceat(both * weight, first, axis=1) * weight[:, None], first, axis=0)
    ones = np.add.reduceat(both.diagonal() * weight, first)
    for a, p in enumerate(first):
        sums[owner[p]] += int(ones[a]) << int(bit[p])
        for c, q in enumerate(first):
            products[owner[p], owner[q]] += int(virtual[a, c]) << int(bit[p] + bit[q])
    return least, sums, products


def principal_axes(n: int, sums: list[int], products: list[list[int]], kept: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(unit eigenvectors as columns, eigenvalues, trace) of the covariance, the largest eigenvalues first."""
    size = len(sums)
    if size == 0:
        return np.zeros((0, 0)), np.zeros(0), 0.0
    square = n * n
    v = np.array([[(n * products[i][j] - sums[i] * sums[j]) / square for j in range(size)] for i in range(size)])
    values, vectors = np.linalg.eigh(v)
    trace = sum(n * products[i][i] - sums[i] ** 2 for i in range(size)) / square
    return vectors[:, ::-1][:, :kept], np.maximum(values[::-1][:kept], 0.0), trace


def project(batches: Iterator[pa.RecordBatch], scale: int, shift: int, n: int, sums: list[int],
            axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Deviation (two words of 62 bits) and whitened components of each vector."""
    s = np.array(sums, dtype=object)
    for b in batches:
        if not b.num_rows:
            continue
        x = integers(b, scale, shift)
        span = max(abs(n * int(x.max()) - min(sums)), abs(n * int(x.min()) - max(sums)))
        if span * span * len(sums) < 1 << 62:
            centred = n * x - s.astype(np.int64)
            high, low = np.zeros(len(x), dtype=np.int64), (centred * centred).sum(axis=1)
        else:
            centred = n * x.astype(object) - s
            squares = (centred * centred).sum(axis=1)
            high = np.array([v >> 62 for v in squares], dtype=np.int64)
            low = np.array([v & (1 << 62) - 1 for v in squares], dtype=np.int64)
        w = (centred / n).astype(float) @ axes
        lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, axes.shape[1], dtype=np.int32), pa.array(w.ravel()))
        yield pa.RecordBatch.from_arrays([b.column("id__"), pa.array(high), pa.array(low), lists],
                                         names=["id__", "high", "low", "w"])


def identity_error(placed: DataFrame, n: int, rank: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    if n == 0 or rank == 0:
        return 0.0
    pairs = [(i, j) for i in range(rank) for j in range(i, rank)]
    w = [F.col("w")[i] for i in range(rank)]
    means = placed.agg(*[F.avg(x) for x in w]).first()
    centred = [x - float(m) for x, m in zip(w, means)]
    got = placed.agg(*[F.sum(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(total / n - (i == j)) for total, (i, j) in zip(got, pairs))
