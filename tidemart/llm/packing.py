"""Mixture-controlled packing of documents into fixed windows by deficit round-robin.

Every source is a queue of tokens (its documents one after another). In each
round a queue's deficit grows by its quantum, it emits the whole tokens of its
deficit and carries the fraction to the next round; windows are cut from the
emitted stream every ``width`` tokens, so a window that ends inside a round
hands the rest of that round to the next window. With the quanta proportional
to the target proportions each window holds them to within a token per source,
and no window but the last has room left; the rest is laid out as windows whose
lengths are powers of two, so nothing is padded at all.

What a queue has emitted after round r is ``min(total, num * r // den)``. Hence
the place of any token follows from its place in its queue and the totals of
all queues, and every task lays out its own documents alone. The steps:

1. one pass makes the ids and, within each task, the running counts by source;
   it is written once (ids and counts must agree, and encoding is the cost),
2. counts by (source, task) are summed; a running sum over tasks gives each
   (source, task) its start in the queue. One row per pair, so a source with a
   third of all rows is as many rows as any other,
3. the starts are joined to the ids (the planner decides by size; both sides
   are keyed by source and task, so no key is larger than one task's share),
4. one pass cuts the pieces.

Every source is a queue of its own at any number of sources. Totals of up to
``max_queues`` are sent to every task; with more, the totals and quanta are joined
to the documents by source, every task cuts its documents by rounds, and the
places are a distributed running sum over the cuts in the order of round, source
and place in the queue. Both ways give the same pieces. With more sources than a
window has tokens, a piece is a single token.

Defined cases: a null or empty text is the end id alone; a null source is a
source of its own; null ids and repeated rows are documents like any other; an
empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, slices, task_count, utf8, write_and_read
from tidemart.llm.tokens import encoder

WIDTH = 4096
END_ID = 2


def pack_mixture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 width: int = WIDTH, end_id: int = END_ID, targets: dict[str | None, float] | None = None,
                 tokenizer_path: str | None = None, max_queues: int = 256) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``targets`` gives sources their share of each window while they last (a
    source it does not name gets the mean of those named); without it the
    shares are those of all tokens, so that all queues end together.
    """
    tokens = write_and_read(count_tokens(df, id_col, text_col, source_col, end_id, tokenizer_path), "pack-ids")
    by_task = tokens.groupBy("source__", "task__").agg(F.sum("n__").alias("sum__"))
    by_source = by_task.groupBy("source__").agg(F.sum("sum__").alias("sum__"))
    few = by_source.limit(max_queues + 1).collect()
    if len(few) > max_queues:
        return pack_many(tokens, by_task, by_source, id_col, width, targets)
    sums = {r["source__"]: int(r["sum__"]) for r in few}
    names = sorted(sums, key=lambda s: (s is None, s))
    queue = F.lit(None).cast("int")
    for i, s in enumerate(names):
        queue = F.when(F.col("source__").eqNullSafe(F.lit(s)), i).otherwise(queue)
    totals = [sums[s] for s in names]
    shares = [_share(targets, s) for s in names] if targets else None
    starts = queue_starts(by_task).withColumn("queue__", queue)
    placed = placed_tokens(tokens, starts).select(id_col, "n__", "ids__", "queue__", "at__")
    return cut_pieces(placed, id_col, Layout(totals, width, shares))


def queue_starts(by_task: DataFrame) -> DataFrame:
    """source__, task__, begin__: where the tokens of a task begin in the queue of their source."""
    order = Window.partitionBy("source__").orderBy("task__")
    return by_task.select("source__", "task__", (F.sum("sum__").over(order) - F.col("sum__")).alias("begin__"))


def placed_tokens(tokens: DataFrame, starts: DataFrame) -> DataFrame:
    """Documents with the other columns of their (source, task) and at__, their place in the queue."""
    right = starts.withColumnsRenamed({"source__": "s__", "task__": "t__"})
    return tokens.join(right, (F.col("task__") == F.col("t__")) & F.col("source__").eqNullSafe(F.col("s__"))).withColumn(
        "at__", F.col("begin__") + F.col("at__"))


def pack_many(tokens: DataFrame, by_task: DataFrame, by_source: DataFrame, id_col: str, width: int,
              targets: dict[str | None, float] | None) -> DataFrame:
    """The same pieces as ``cut_pieces``, for sources too many to send their totals to every task."""
    quantum = F.col("sum__")
    if targets:
        quantum = F.lit(_quantum(sum(targets.values()) / len(targets)))
        for s, x in targets.items():
            quantum = F.when(F.col("source__").eqNullSafe(F.lit(s)), _quantum(float(x))).otherwise(quantum)
    quanta = by_source.select(F.col("source__").alias("q__"), quantum.cast("long").alias("quantum__"), "sum__")
    total, parts = quanta.agg(F.sum("sum__"), F.sum("quantum__")).first()
    scale, den = (width, int(parts)) if targets else (1, max(1, -(-int(total) // width)))
    starts = queue_starts(by_task).join(quanta, F.col("source__").eqNullSafe(F.col("q__"))).select(
        "source__", "task__", "begin__", "quantum__")
    placed = placed_tokens(tokens, starts).select(id_col, "n__", "ids__", "source__", "quantum__", "at__")
    cut_schema = T.StructType([placed.schema[id_col], placed.schema["source__"]] + [T.StructField(c, k) for c, k in (
        ("round__", T.LongType()), ("begin__", T.LongType()), ("start__", T.LongType()), ("length__", T.LongType()),
        ("n__", T.LongType()), ("cut__", T.BinaryType()))])

    def by_rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ids__", 1 << 20):
            n, at, num = (b.column(c).to_numpy().astype(object) for c in ("n__", "at__", "quantum__"))
            if int(total) * max(den, int(num.max()) * scale) < 1 << 61:  # else Python's integers
                n, at, num = (x.astype(np.int64) for x in (n, at, num))
            row, rounds = rounds_of(at, n, num * scale, den)
            line = (num * scale)[row]
            begin = np.maximum((rounds - 1) * line // den, at[row]).astype(np.int64)
            length = np.minimum(rounds * line // den, (at + n)[row]).astype(np.int64) - begin
            start, ids = begin - at[row].astype(np.int64), b.column("ids__").to_pylist()
            cut = [ids[r][2 * s:2 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist())]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).take(taken), b.column("source__").take(taken), pa.array(rounds.astype(np.int64)),
                 pa.array(begin), pa.array(start), pa.array(length), b.column("n__").take(taken),
                 pa.array(cut, pa.binary())], names=cut_schema.names)

    order = ["round__", F.col("source__").isNull(), "source__", "begin__"]
    cuts = arrow_map(placed, by_rounds, cut_schema)
    cuts = cuts.repartitionByRange(task_count(cuts), *order).sortWithinPartitions(*order)
    run_schema = T.StructType([cut_schema[id_col]] + [cut_schema[c] for c in ("start__", "length__", "n__", "cut__")] + [
        T.StructField("part__", T.IntegerType()), T.StructField("place__", T.LongType())])

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            ends = seen + np.cumsum(b.column("length__").to_numpy())
            place = ends - b.column("length__").to_numpy()
            seen = int(ends[-1]) if len(ends) else seen
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in run_schema.names[:5]] + [pa.array([part] * len(place), pa.int32()), pa.array(place)],
                names=run_schema.names)

    # written once: another evaluation may range rows otherwise
    laid = write_and_read(arrow_map(cuts, running, run_schema), "pack-rounds")
    before, sums = 0, {}
    for r in sorted(laid.groupBy("part__").agg(F.sum("length__").alias("s")).collect(), key=lambda r: r["part__"]):
        sums[r["part__"]], before = before, before + int(r["s"])
    layout = Layout([int(total)], width)
    schema = piece_schema(laid, id_col)

    def to_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "cut__", 1 << 20):
            place = b.column("place__").to_numpy() + np.array([sums[p] for p in b.column("part__").to_pylist()])
            first = b.column("start__").to_numpy()
            row, start, length, sequence, offset = layout.windows(
                np.arange(b.num_rows), first, b.column("length__").to_numpy(), place)
            yield piece_batch(b, id_col, "cut__", row, start, length, sequence, offset, first, schema)

    return arrow_map(laid, to_windows, schema)


def _share(targets: dict[str | None, float], source: str | None) -> float:
    return float(targets.get(source, sum(targets.values()) / len(targets)))


def _quantum(share: float) -> int:
    return int(Fraction(share).limit_denominator(1000) * 1000) or 1


def rounds_of(at: np.ndarray, n: np.ndarray, num: np.ndarray, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, round) for all rounds that emit tokens of documents at these places of queues with these quanta."""
    first = -(-(at + 1) * den // num)  # the round that emits token ``at``: least r with num * r // den > at
    last = -(-(at + n) * den // num)
    single = num < den  # at most a token in a round, and none in most
    count = np.where(single, n, last - first + 1).astype(np.int64)
    row = np.repeat(np.arange(len(at)), count)
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return row, np.where(single[row], -(-(at[row] + step + 1) * den // num[row]), first[row] + step)


def count_tokens(df: DataFrame, id_col: str, text_col: str, source_col: str, end_id: int,
                 tokenizer_path: str | None) -> DataFrame:
    """id, source__, ids__ (16-bit), n__, task__, at__: tokens of this source before it in its task."""
    picked = df.select(F.col(id_col), F.col(source_col).cast("string").alias("source__"),
                       F.col(text_col).cast("string").alias("text__"))
    schema = T.StructType([picked.schema[0], picked.schema[1], T.StructField("ids__", T.BinaryType()),
                           T.StructField("n__", T.LongType()), T.StructField("task__", T.IntegerType()),
                           T.StructField("at__", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        end = np.array([end_id], dtype="<u2").tobytes()
        for b in slices(batches, "text__"):
            ids = [x + end for x in encode(utf8(b.column("text__")))]
            n, at = [len(x) // 2 for x in ids], []
            for s, k in zip(b.column("source__").to_pylist(), n):
                at.append(seen.get(s, 0))
                seen[s] = at[-1] + k
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column("source__"), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                 pa.array([task] * len(n), pa.int32()), pa.array(at, pa.int64())], names=schema.names)

    return arrow_map(picked, run, schema)


class Layout:
    """Places of tokens in the emitted stream, from the queues' totals and quanta alone."""

    def __init__(self, totals: list[int], width: int, shares: list[float] | None = None):
        self.width, self.totals = width, np.array(totals, dtype=np.int64)
        total = int(self.totals.sum())
        if shares is None:  # quanta that empty all queues in the same round
            self.num, self.den = self.totals, max(1, -(-total // width))
        else:
            scaled = [_quantum(x) for x in shares]
            self.num, self.den = np.array(scaled, dtype=np.int64) * width, sum(scaled)
        self.full = total // width * width
        rest, edges = total - self.full, [self.full]
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        self.edges = np.array(edges, dtype=np.int64)

    def emitted(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens of every queue (columns) after each of these rounds (rows)."""
        return np.minimum(self.totals[None, :], rounds[:, None] * self.num[None, :] // self.den)

    def pieces(self, queue: np.ndarray, at: np.ndarray, n: np.ndarray):
        """(row, start in the document, length, sequence, offset) of all pieces of documents at these places."""
        row, rounds = rounds_of(at, n, self.num[queue], self.den)
        q = queue[row]
        before, after = self.emitted(rounds - 1), self.emitted(rounds)
        line = np.arange(len(row))
        own = before[line, q]
        begin = np.maximum(own, at[row])
        length = np.minimum(after[line, q], at[row] + n[row]) - begin
        earlier = np.cumsum(after - before, axis=1)
        place = before.sum(axis=1) + earlier[line, q] - (after[line, q] - own) + begin - own
        start = begin - at[row]
        return self.windows(*(x[length > 0] for x in (row, start, length, place)))

    def windows(self, row: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray):
        """(row, start, length, sequence, offset) of the parts of these stretches of the stream in windows."""
        out = []
        while len(row):
            tail = np.searchsorted(self.edges, place, side="right")
            in_tail = place >= self.full
            stop = np.where(in_tail, self.edges[np.minimum(tail, len(self.edges) - 1)],
                            (place // self.width + 1) * self.width)
            sequence = np.where(in_tail, self.full // self.width + tail - 1, place // self.width)
            base = np.where(in_tail, self.edges[np.maximum(tail - 1, 0)], sequence * self.width)
            head = np.minimum(length, stop - place)
            out.append((row, start, head, sequence, place - base))
            more = length > head
            row, start, length, place = row[more], (start + head)[more], (length - head)[more], (place + head)[more]
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 5


def cut_pieces(placed: DataFrame, id_col: str, layout: Layout) -> DataFrame:
    """Pieces of documents whose queue__, at__ (place in the queue), n__ and ids__ are given."""
    schema = piece_schema(placed, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ids__", 1 << 20):
            queue, at, n = (b.column(c).to_numpy().astype(np.int64) for c in ("queue__", "at__", "n__"))
            row, start, length, sequence, offset = layout.pieces(queue, at, n)
            yield piece_batch(b, id_col, "ids__", row, start, length, sequence, offset, np.zeros_like(at), schema)

    return arrow_map(placed, run, schema)


def piece_schema(df: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([df.schema[id_col]] + [T.StructField(c, k) for c, k in (
        ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
        ("sequence_id", T.LongType()), ("offset", T.LongType()))])


def piece_batch(b: pa.RecordBatch, id_col: str, ids: str, row: np.ndarray, start: np.ndarray, length: np.ndarray,
                sequence: np.ndarray, offset: np.ndarray, first: np.ndarray, schema: T.StructType) -> pa.RecordBatch:
    """Rows of pieces; ``first`` is the place in the document at which a row's ids begin."""
    wide = [np.frombuffer(x, dtype="<u2").astype("<u4").tobytes() for x in b.column(ids).to_pylist()]
    cut = [wide[r][4 * s:4 * (s + k)] for r, s, k in zip(row.tolist(), (start - first[row]).tolist(), length.tolist())]
    return pa.RecordBatch.from_arrays(
        [b.column(id_col).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(cut, pa.binary()),
         b.column("n__").take(pa.array(row)), pa.array(sequence), pa.array(offset)], names=schema.names)
