"""Removal of long repeated byte strings with run-length indexes.

A window is ``length`` consecutive bytes of one text. Each byte inside a window
that also starts anywhere else in the corpus is removed; windows are judged on
the input. One index over the corpus does not fit a task, so windows are dealt
out such that equal windows always meet, and an index is built per group:

1. The smallest hash among a window's ``k``-byte substrings depends on nothing
   but its bytes. A text is cut into segments, the maximal runs of windows with
   one smallest hash; each window lies in exactly one segment and equal windows
   lie in segments of equal hash. One row per segment is written: hash, 128-bit
   digest of the segment's bytes, place.
2. Rows are counted by hash (partially aggregated). A hash met once, in one
   place, has no repeated window: such segments, nearly all of a clean corpus,
   go no further. If all segments of a hash are equal, all of their windows
   repeat and no text is needed: exact and long copies end here.
3. Hashes with different segments (the edges of copied passages) are settled
   with text: one copy of each distinct segment is fetched, dealt out by hash,
   and each task builds run-length indexes (``rindex``) over whole groups of a
   few megabytes and streams the matching statistics of the set; windows with a
   match of ``length`` or more are marked.
4. A group whose distinct segments exceed ``group_bytes`` is never put in one
   task. Its segments are cut again, by the smallest hash of longer substrings,
   and take the same way; of groups that are still too large the windows are
   counted by their digests, each digest once per segment, which spreads over
   all tasks whatever the hash: what repeats inside a segment (periodic text)
   is a span at once. Digests met by many rows are joined by broadcast.

Spans then meet the whole texts once more, keyed by row, and are cut out.

Defined cases: a null or empty text has no bytes; texts shorter than ``length``
keep everything; repeated rows are texts of their own, so all their windows of
full length repeat; null ids are allowed; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, row_key, slices, task_count, utf8, write_and_read
from tidemart.llm.rindex import long_matches

LENGTH = 400
ANCHOR = 64
LONG_ANCHOR = 256
GROUP_BYTES = 1 << 20
INDEX_BYTES = 1 << 20
CUT_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
KEY = ["k_id", "k_text"]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES, long_anchor: int | None = None, as_text: bool = False,
                   carry: list[str] | None = None) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept: one row per input row.

    ``kept`` is the remaining bytes; with ``as_text`` a string without the
    characters that a cut has split. Columns named in ``carry`` pass through.
    """
    spans = repeated_spans(df, id_col, text_col, length, anchor, group_bytes, long_anchor)
    by_text = spans.distinct().groupBy(*KEY).agg(F.collect_list(F.struct("begin", "stop")).alias("spans__"))
    texts = df.select(id_col, *(carry or []), *row_key(id_col, text_col),
                      F.col(text_col).cast("string").alias("text__"))
    spans_of = by_text.withColumnsRenamed({c: c + "_s" for c in KEY})
    joined = texts.join(spans_of, F.col("k_id").eqNullSafe(F.col("k_id_s")) & (F.col("k_text") == F.col("k_text_s")),
                        "left").select(id_col, *(carry or []), "text__", F.col("spans__.begin").alias("from__"),
                                       F.col("spans__.stop").alias("to__"))
    return cut_out(joined, [id_col, *(carry or [])], as_text)


def repeated_spans(df: DataFrame, id_col: str, text_col: str, length: int = LENGTH, anchor: int = ANCHOR,
                   group_bytes: int = GROUP_BYTES, long_anchor: int | None = None) -> DataFrame:
    """(k_id, k_text, begin, stop): byte spans whose every byte lies in a repeated window; they may overlap."""
    texts = df.select(*row_key(id_col, text_col), F.col(text_col).cast("string").alias("text__"))
    rows = write_and_read(segments(texts, length, anchor), "segments")
    found, distinct, large = settle(rows, length, group_bytes)
    pieces = fetch(texts, distinct, length)
    if large is not None:
        pieces = write_and_read(pieces, "segment-texts")
        again = write_and_read(cut_pieces(pieces.join(large, F.col("hash") == F.col("h"), "left_semi"), length,
                                          long_anchor or min(length, max(anchor, LONG_ANCHOR))), "segments")
        pieces = pieces.join(large, F.col("hash") == F.col("h"), "left_anti")
        more, distinct, large = settle(again, length, group_bytes)
        found = found.unionByName(more)
        shorter = distinct.select(*(F.col(f"place.{c}").alias(c) for c in KEY), "hash", "d0", "d1", "n",
                                  F.col("place.begin").alias("begin"), "piece")
        if large is not None:
            found = found.unionByName(count_windows(
                shorter.join(large, F.col("hash") == F.col("h"), "left_semi"), length))
            shorter = shorter.join(large, F.col("hash") == F.col("h"), "left_anti")
        pieces = pieces.unionByName(shorter)
    dealt = pieces.repartition(task_count(df), "hash").sortWithinPartitions("hash")
    return found.unionByName(index_groups(dealt, length))


def settle(rows: DataFrame, length: int, group_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """What counting alone settles: spans, the distinct segments left over, and the hashes of over-large groups."""
    by_hash = rows.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min("d0").alias("a0"), F.max("d0").alias("b0"),
        F.min("d1").alias("a1"), F.max("d1").alias("b1")).where("n > 1 or again").select(
        F.col("hash").alias("h"), (F.expr("n > 1 and a0 = b0 and a1 = b1")).alias("equal"))
    met = write_and_read(rows.join(by_hash, F.col("hash") == F.col("h")).drop("h"), "segments-met")
    span = [F.col("begin"), (F.col("begin") + F.col("windows") + (length - 1)).alias("stop")]
    found = met.where("equal").select(*KEY, *span)

    mixed = met.where("not equal")
    place = F.struct(*KEY, "begin", "windows")
    text = [F.first("piece").alias("piece")] if "piece" in rows.columns else []
    distinct = write_and_read(mixed.groupBy("hash", "d0", "d1").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("place"), *text), "segments-distinct")
    copied = distinct.where("n > 1").select("hash", "d0", "d1", "n")
    found = found.unionByName(meet(mixed, copied, ["hash", "d0", "d1"]).select(*KEY, *span))
    sizes = distinct.groupBy("hash").agg(F.sum(F.col("place.windows") + (length - 1)).alias("bytes"))
    large = write_and_read(sizes.where(F.col("bytes") > group_bytes).select(F.col("hash").alias("h")), "segments-large")
    return found, distinct, large if large.limit(1).count() else None


def meet(rows: DataFrame, counted: DataFrame, on: list[str], share: int = 1000) -> DataFrame:
    """``rows`` whose key is in ``counted``: one row per key, where ``n`` is the number of its ``rows``.

    ``rows`` should be file-backed; it is read three times. Keys that hold more
    than 1 / ``share`` of the rows, always fewer than ``share``, are broadcast;
    the others meet by key.
    """
    total = rows.count()
    often = F.broadcast(counted.where(F.col("n") * share > total).select(*on))
    usual = counted.where(F.col("n") * share <= total).select(*on)
    return rows.join(often, on, "left_semi").unionByName(
        rows.join(often, on, "left_anti").join(usual, on, "left_semi")).select(*rows.columns)


def segments(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """One row per segment: hash, digest (d0, d1), key, begin, windows, again (its smallest hash occurs twice)."""
    schema = T.StructType([texts.schema["k_id"], texts.schema["k_text"]] + [
        T.StructField(c, T.LongType()) for c in ("hash", "d0", "d1", "begin", "windows")] + [
        T.StructField("again", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__", CUT_BYTES):
            raw = utf8(b.column("text__"))
            row, digest, *rest = cut_segments(raw, length, anchor)
            pick = pa.array(row)
            d = np.frombuffer(digest, dtype="<i8").reshape(-1, 2)
            h, begin, windows, again = rest
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pick), b.column(1).take(pick), pa.array(h.view(np.int64)), pa.array(d[:, 0]),
                 pa.array(d[:, 1]), pa.array(begin), pa.array(windows), pa.array(again)], names=schema.names)

    return arrow_map(texts.where(F.octet_length("text__") >= length), run, schema)


def cut_pieces(pieces: DataFrame, length: int, anchor: int) -> DataFrame:
    """Segments of segment texts by a longer anchor, with their own texts; one row per distinct segment goes in."""
    schema = T.StructType([pieces.schema["k_id"], pieces.schema["k_text"]] + [
        T.StructField(c, T.LongType()) for c in ("hash", "d0", "d1", "begin", "windows")] + [
        T.StructField("again", T.BooleanType()), T.StructField("piece", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "piece", CUT_BYTES):
            raw = b.column("piece").to_pylist()
            row, digest, h, begin, windows, again = cut_segments(raw, length, anchor)
            pick, d = pa.array(row), np.frombuffer(digest, dtype="<i8").reshape(-1, 2)
            parts = [raw[r][s:s + w + length - 1] for r, s, w in zip(row.tolist(), begin.tolist(), windows.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("k_id").take(pick), b.column("k_text").take(pick), pa.array(h.view(np.int64)),
                 pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(begin + b.column("begin").to_numpy()[row]),
                 pa.array(windows), pa.array(again), pa.array(parts, pa.binary())], names=schema.names)

    return arrow_map(pieces.dropDuplicates(["hash", "d0", "d1"]), run, schema)


def cut_segments(raw: list[bytes], length: int, anchor: int):
    """(row, digests, hash, begin, windows, again) of all segments of these texts."""
    size = np.array([len(x) for x in raw], dtype=np.int64)
    joined = b"".join(raw)
    if len(joined) < length or not (size >= length).any():
        none = np.zeros(0, dtype=np.int64)
        return none, b"", none.view(np.uint64), none, none, np.zeros(0, dtype=bool)
    base = np.cumsum(size) - size
    g = mixed_hashes(np.frombuffer(joined, dtype=np.uint8), anchor)
    w = length - anchor + 1
    least = sliding_min(g, w)  # by window start over the joined bytes
    count = np.maximum(size - length + 1, 0)
    valid = np.repeat(base, count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    row = np.repeat(np.arange(len(raw)), count)
    m = least[valid]
    new = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (row[1:] != row[:-1])])
    windows = np.diff(np.r_[new, len(m)])
    start, value, row = valid[new], m[new], row[new]
    digest = xxhash.xxh3_128_digest
    stops = start + windows + (length - 1)
    marks = b"".join([digest(joined[a:b]) for a, b in zip(start.tolist(), stops.tolist())])
    again = np.array([np.count_nonzero(g[a:b] == v) > 1 for a, b, v in
                      zip(start.tolist(), (start + windows + (w - 1)).tolist(), value)], dtype=bool)
    return row, marks, value, start - base[row], windows, again


def mixed_hashes(text: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k``-byte substring: a rolling polynomial, then mixed."""
    n = len(text)
    with np.errstate(over="ignore"):
        power = np.full(n, BASE, dtype=np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        inverse = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        total = np.r_[np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)]
        x = (total[k:] - total[:-k]) * inverse[:n - k + 1]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by running minima from both ends of blocks of ``w``."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def fetch(texts: DataFrame, distinct: DataFrame, length: int) -> DataFrame:
    """The bytes of one copy of each distinct segment: hash, d0, d1, n, key, begin, piece."""
    wanted = distinct.groupBy("place.k_id", "place.k_text").agg(F.collect_list(F.struct(
        "hash", "d0", "d1", "n", "place.begin", "place.windows")).alias("want__"))
    wanted = wanted.withColumnsRenamed({c: c + "_w" for c in KEY})
    joined = texts.join(wanted, F.col("k_id").eqNullSafe(F.col("k_id_w")) & (F.col("k_text") == F.col("k_text_w")))
    numbers = ("hash", "d0", "d1", "n", "begin", "windows")
    joined = joined.select(*KEY, "text__", *(F.col(f"want__.{c}").alias(c) for c in numbers))
    schema = T.StructType([texts.schema["k_id"], texts.schema["k_text"]] + [
        T.StructField(c, T.LongType()) for c in numbers[:5]] + [T.StructField("piece", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__"):
            lists = b.column("begin")
            row = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
            flat = {c: b.column(c).flatten().to_numpy() for c in numbers}
            raw = utf8(b.column("text__"))
            pieces = [raw[r][s:s + w + length - 1] for r, s, w in
                      zip(row.tolist(), flat["begin"].tolist(), flat["windows"].tolist())]
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pick), b.column(1).take(pick), *(pa.array(flat[c]) for c in numbers[:5]),
                 pa.array(pieces, pa.binary())], names=schema.names)

    return arrow_map(joined, run, schema)


def index_groups(dealt: DataFrame, length: int) -> DataFrame:
    """Spans found by an index over each few megabytes of whole groups; rows come sorted by hash."""
    schema = T.StructType([dealt.schema["k_id"], dealt.schema["k_text"], T.StructField("begin", T.LongType()),
                           T.StructField("stop", T.LongType())])

    def settle(held: pa.Table) -> pa.RecordBatch:
        d = np.stack([held.column(c).to_numpy() for c in ("hash", "d0", "d1")], axis=1)
        _, first = np.unique(d, axis=0, return_index=True)  # a repeated row has fetched its segment twice
        first.sort()
        pieces = held.column("piece").take(pa.array(first)).to_pylist()
        found = long_matches(pieces, length)
        n, begin = held.column("n").to_numpy()[first], held.column("begin").to_numpy()[first]
        found = [(w, a, b) for w, a, b in found if n[w] == 1]  # others are spans already
        pick = pa.array(first[[w for w, _, _ in found]] if found else [], pa.int64())
        return pa.RecordBatch.from_arrays(
            [held.column("k_id").take(pick).combine_chunks(), held.column("k_text").take(pick).combine_chunks(),
             pa.array([int(begin[w]) + a for w, a, _ in found], pa.int64()),
             pa.array([int(begin[w]) + b for w, _, b in found], pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in slices(batches, "piece", INDEX_BYTES):
            held.append(b)
            size += b.column("piece").nbytes
            if size < INDEX_BYTES:
                continue
            table = pa.Table.from_batches(held)
            h = table.column("hash").to_numpy()
            cut = int(np.flatnonzero(h == h[-1])[0])  # the last group may go on
            if cut:
                yield settle(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = sum(x.column("piece").nbytes for x in held)
        if held:
            yield settle(pa.Table.from_batches(held))

    return arrow_map(dealt, run, schema)


def count_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of windows of over-large groups, the windows counted by their digests."""
    windows = write_and_read(distinct_windows(pieces.dropDuplicates(["hash", "d0", "d1"]), length), "windows")
    counted = windows.where("times > 0").groupBy("d0", "d1").agg(
        F.count(F.when(F.col("times") == 1, 1)).alias("n"), F.sum("times").alias("times")).where("times > 1")
    span = [*KEY, "begin", "stop"]
    return windows.where("times = 0").select(*span).unionByName(
        meet(windows.where("times = 1"), counted, ["d0", "d1"]).select(*span))


def distinct_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Each piece's windows, one row per digest with its ``times`` in the piece; with 0 times, spans of those met twice."""
    schema = T.StructType([pieces.schema["k_id"], pieces.schema["k_text"]] + [
        T.StructField(c, T.LongType()) for c in ("begin", "stop", "d0", "d1", "times")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "piece", 1 << 18):
            raw, digest = b.column("piece").to_pylist(), xxhash.xxh3_128_digest
            count = np.array([len(x) - length + 1 for x in raw])
            row = np.repeat(np.arange(len(raw)), count)
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            d = np.frombuffer(b"".join([digest(raw[r][s:s + length]) for r, s in zip(row.tolist(), at.tolist())]),
                              dtype="<i8").reshape(-1, 2)
            order = np.lexsort((d[:, 1], d[:, 0], row))
            key = np.stack([row, d[:, 0], d[:, 1]], axis=1)[order]
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            times = np.diff(np.r_[new, len(order)])
            once = order[new]
            twice = np.sort(order[np.repeat(times > 1, times)])  # met again inside the piece: runs of them are spans
            gap = (np.diff(twice) > 1) | (np.diff(row[twice]) > 0)
            first, last = twice[np.r_[True, gap][:len(twice)]], twice[np.r_[gap, True][:len(twice)]]
            none = np.zeros(len(first), dtype=np.int64)
            from_, to = np.r_[once, first], np.r_[once, last]
            pick, base = pa.array(row[from_]), b.column("begin").to_numpy()[row[from_]]
            yield pa.RecordBatch.from_arrays(
                [b.column("k_id").take(pick), b.column("k_text").take(pick), pa.array(base + at[from_]),
                 pa.array(base + at[to] + length), pa.array(np.r_[d[once, 0], none]), pa.array(np.r_[d[once, 1], none]),
                 pa.array(np.r_[times, none])], names=schema.names)

    return arrow_map(pieces, run, schema)


def cut_out(joined: DataFrame, keep: list[str], as_text: bool) -> DataFrame:
    """Whole texts without their spans (from__, to__)."""
    schema = T.StructType([joined.schema[c] for c in keep] + [
        T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [
        T.StructField("kept", T.StringType() if as_text else T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__"):
            raw = utf8(b.column("text__"))
            removed, spans, kept = [], [], []
            for t, begin, stop in zip(raw, b.column("from__").to_pylist(), b.column("to__").to_pylist()):
                runs = union(begin, stop) if begin else []
                removed.append(sum(y - x for x, y in runs))
                spans.append(len(runs))
                parts = [t[x:y] for x, y in zip([0, *(y for _, y in runs)], [*(x for x, _ in runs), len(t)])]
                left = b"".join(p.decode("utf-8", "ignore").encode() for p in parts) if as_text else b"".join(parts)
                kept.append(left.decode() if as_text else left)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array([len(t) for t in raw], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.string() if as_text else pa.binary())], names=schema.names)

    return arrow_map(joined, run, schema)


def union(begin: list[int], stop: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(begin, stop)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
