"""SimHash near-duplicates through an inverted index on byte positions.

A 64-bit fingerprint is eight bytes at eight positions. Two fingerprints that
differ in at most ``max_bits`` (4) bits differ in at most 4 bytes, so they share
at least 8 - 4 = 4 (position, byte) entries: that is the guaranteed minimum of
the count filter. Lists of a single (position, byte) would be a 256th of the
corpus each, so the index is kept on triples of positions: twenty triples, of
which any four shared positions contain at least one whole (every 4 of 8 points
contain a block of the design below), hence no pair is missed. Within a list,
the shared positional bytes of each pair are tallied, pairs below the minimum
are dropped, the rest is verified by the bit distance.

Scale: equal fingerprints are one node of the graph (copies are expanded only
by the final join). Lists with one member are dropped by a counted join before
anything is compared. A list of up to ``list_limit`` members is compared inside
one task and gives only a spanning forest of its links. A longer list is not
compared at all: its members share three bytes, so two linked members differ in
at most 4 of the remaining 40 bits, and then some value lies within 2 bits of
both; each member is sent to all values within 2 of those bits and linked to
the smallest member met there. This is exact, linear in the members and needs
no group in one task.

Defined cases: a null or empty text has no words and fingerprint zero, linked
like any other; repeated rows and equal texts share a fingerprint and thus a
component; a null id is never the smallest (null component only if all ids of
the component are null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, map_texts, task_count, write_and_read
from tidemart.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of the 8 positions such that any 4 positions contain one whole.

    The positions form three groups in a circle; a triple is taken when it lies
    in one group or has two positions in a group and one in the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for c in combinations(range(8), 3):
        g = [group[p] for p in c]
        for k in range(3):
            if g.count(k) == 3 or (g.count(k) == 2 and g.count((k + 1) % 3) == 1):
                out.append(c)
    return out


TRIPLES = position_triples()


def fingerprints(df: DataFrame, keep: list[str], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and fp__, the 64-bit fingerprint as a signed long, of whole texts."""
    def run(texts: list[bytes]) -> dict:
        return {"fp__": np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)}

    return map_texts(df, keep, text_col, run, T.StructType([T.StructField("fp__", T.LongType())]))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    stops = np.cumsum(np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words)))
    starts = np.r_[0, stops[:-1]]
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((h(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), (stops[k - 1:] - 1).tolist())),
                         dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS, list_limit: int = 8192) -> DataFrame:
    """id, fp, component (smallest id reachable over links of at most ``max_bits`` bits), one row per input row."""
    prints = write_and_read(fingerprints(df, [id_col], text_col, shingle), "simhash")
    named = components_of_prints(prints, id_col, max_bits, list_limit)
    return prints.join(named, F.col("fp__") == F.col("f")).select(id_col, F.col("fp__").alias("fp"), "component")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS, list_limit: int = 8192) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row of its smallest id.

    Of repeated rows with that id one stays; a row without an id stays only
    where no row of its component has one. The rows are written with their
    fingerprints and a row number, so that each is chosen by itself.
    """
    columns = df.columns
    rows = write_and_read(fingerprints(df, columns, text_col, shingle).withColumn(
        "row__", F.monotonically_increasing_id()), "simhash-rows")
    named = components_of_prints(rows.select(id_col, "fp__"), id_col, max_bits, list_limit)
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "row__")).alias("first")
    by_print = rows.groupBy("fp__").agg(first)
    winners = by_print.join(named, F.col("fp__") == F.col("f")).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(winners.select(F.col("first.row__").alias("w__")), F.col("row__") == F.col("w__"),
                     "left_semi").select(columns)


def components_of_prints(prints: DataFrame, id_col: str, max_bits: int, list_limit: int) -> DataFrame:
    """(f, root, component) of every distinct fingerprint; ``prints`` has the id and fp__."""
    links = fingerprint_links(prints.select(F.col("fp__").alias("fp")).distinct(), max_bits, list_limit)
    of_print = connected_components(links)
    classes = prints.groupBy("fp__").agg(F.min(id_col).alias("least__"))
    joined = write_and_read(classes.join(of_print, F.col("fp__") == F.col("node"), "left").select(
        F.col("fp__").alias("f"), "least__", F.coalesce("component", "fp__").alias("root")), "simhash-classes")
    smallest = joined.groupBy(F.col("root").alias("r")).agg(F.min("least__").alias("component"))
    return joined.join(smallest, F.col("root") == F.col("r")).select("f", "root", "component")


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, list_limit: int = 8192) -> DataFrame:
    """Edges (a, b) with the components of the graph of distinct fingerprints at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the position index guarantees bit distances up to 4")
    entries = []
    for i, triple in enumerate(TRIPLES):
        value = F.lit(i)
        for p in triple:
            value = F.shiftleft(value.cast("bigint"), 8).bitwiseOR(
                F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)))
        entries.append(value)
    index = prints.select("fp", F.explode(F.array(*entries)).alias("entry"))
    sizes = index.groupBy("entry").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select(
        F.col("entry").alias("e"), "size")
    shared = write_and_read(index.join(sizes, F.col("entry") == F.col("e")).select("entry", "size", "fp"), "simhash-lists")
    lists = shared.where(F.col("size") <= list_limit).select("entry", "fp")
    near = arrow_map(lists.repartition(task_count(prints), "entry").sortWithinPartitions("entry", "fp"),
                     lambda batches: compare_lists(batches, max_bits), "a long, b long")
    long_lists = shared.where(F.col("size") > list_limit).select("entry", "fp")
    met = arrow_map(long_lists, lambda batches: midpoints(batches, max_bits),
                    "middle long, entry long, fp long, inner boolean")
    least = met.groupBy("middle", "entry").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"),
                                               F.count(F.lit(1)).alias("n")).where("n > 1 and a is not null")
    far = met.join(least.drop("n"), ["middle", "entry"]).select("a", F.col("fp").alias("b")).where("a <> b")
    return near.unionByName(far).distinct()


def compare_lists(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Forests of the links of each list; the rows come sorted by list, no list exceeds the limit."""
    held_e, held_f = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for b in batches:
        e = np.concatenate([held_e, b.column(0).to_numpy()])
        f = np.concatenate([held_f, b.column(1).to_numpy()])
        if not len(e):
            continue
        last = np.searchsorted(e, e[-1])  # the last list may go on in the next batch
        yield _forest(e[:last], f[:last], max_bits)
        held_e, held_f = e[last:], f[last:]
    if len(held_e):
        yield _forest(held_e, held_f, max_bits)


def _forest(e: np.ndarray, f: np.ndarray, max_bits: int) -> pa.RecordBatch:
    a_out, b_out = [], []
    if len(e):
        cuts = np.flatnonzero(np.diff(e)) + 1
        starts, stops = np.r_[0, cuts], np.r_[cuts, len(e)]
        size = stops - starts
        two = starts[size == 2]  # most lists
        a, b = f[two], f[two + 1]
        ok = linked(a, b, max_bits)
        a_out.append(a[ok])
        b_out.append(b[ok])
        for s, t in zip(starts[size > 2].tolist(), stops[size > 2].tolist()):
            x, y = list_forest(f[s:t], max_bits)
            a_out.append(x)
            b_out.append(y)
    a = np.concatenate(a_out) if a_out else np.zeros(0, dtype=np.int64)
    b = np.concatenate(b_out) if b_out else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally of shared positional bytes at least 8 - max_bits, then the bit distance."""
    differ = np.bitwise_xor(a, b).view(np.uint64)
    tally = 8 - np.count_nonzero(np.ascontiguousarray(differ).view(np.uint8).reshape(*differ.shape, 8), axis=-1)
    near = tally >= 8 - max_bits
    near[near] = np.bitwise_count(differ[near]) <= max_bits
    return near


def list_forest(f: np.ndarray, max_bits: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first over one list: each member is compared with those not reached yet."""
    left, a_out, b_out = np.arange(len(f)), [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            heads, queue = queue[:block], queue[block:]
            near = linked(f[heads][:, None], f[left][None, :], max_bits)
            hit = near.any(axis=0)
            if hit.any():
                who = np.array(heads)[near[:, hit].argmax(axis=0)]
                a_out.append(f[who])
                b_out.append(f[left[hit]])
                queue.extend(left[hit].tolist())
                left = left[~hit]
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)


def midpoints(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Every value within half the distance of a member over the bits outside its list's triple.

    ``inner`` marks values within the smaller half, for odd distances: a member
    inside and any other member that meet are within the whole distance.
    """
    for b in batches:
        for entry, fp in zip(b.column(0).to_numpy().tolist(), b.column(1).to_numpy()):
            triple = TRIPLES[entry >> 24]
            bits = [int(np.uint64(1 << k).view(np.int64)) for k in range(64) if k // 8 not in triple]
            flips, inner = [0], [True]
            for r in range(1, (max_bits + 1) // 2 + 1):
                some = [sum(c) for c in combinations(bits, r)]
                flips += some
                inner += [r <= max_bits // 2] * len(some)
            mids = np.bitwise_xor(fp, np.array(flips, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mids), pa.array(np.full(len(mids), entry)), pa.array(np.full(len(mids), fp)),
                 pa.array(inner)], names=["middle", "entry", "fp", "inner"])
