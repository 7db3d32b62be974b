"""Phrase collocation mining with counting quotient filters.

Words that occur often enough get dense ids (a phrase is never more frequent
than its words, so no other word can be in a candidate). A phrase of two to four
ids is packed into two halves of 2 * bits bits, and a Feistel network permutes
the pair: invertible at any width, so nothing is lost. The permuted number is
split into a block, a quotient and the full remainder. A filter holds, for one
block, the runs of its quotients in unary (the quotient filter's occupied and
continuation bits), the remainders in sorted order and a counter for each, one
byte or an escaped long. Tasks build filters over their text and emit them when
they hold ``FILTER_ENTRIES`` phrases; the filters of a block meet in one place,
are decoded in order and merged by adding counters. Frequent entries are
permuted back into word ids.

A candidate's parts are looked up among the counted phrases (every part is at
least as frequent as the candidate, so it has been counted).

Scale: text is cut into segments of at most about 8 MB, long texts too (a segment then
begins with the three tokens before it, and a phrase belongs to the segment of
its last word). A segment's distinct words meet the dictionary in an equi join,
so the dictionary is never broadcast; segments, their words and filters are
bounded by constants, and blocks grow in number with the words of the corpus,
so that a merge holds a bounded part. Counts of a hot word or phrase are added
per task before they are shuffled; a word that stands in a third of all
candidates is looked up by ``common.lookup``. The best phrases are taken in two
steps, first in 64 parts of each language.

Defined cases: a null text is empty; a null language is "und", together with
rows that say "und"; empty pieces and texts have no words; repeated rows count
again; an empty table gives no rows; other columns are ignored. More than 2^31
frequent words raise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import arrow_map, lookup, slices, task_count, utf8, write_and_read
from tidemart.operators.keys import dense_keys

LONGEST = 4
FILTER_ENTRIES = 1 << 21
SEGMENT_BYTES = 8 << 20
ROUND_KEYS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)
#: upper case to lower case, tab to space, the ends of pieces to a full stop
TABLE = bytes(0x2E if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b
              for b in range(256))
GAPS = re.compile(rb"[ .]")


def mine_collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000,
                      covered: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    ``least`` is the smallest count of a phrase; a phrase inside a longer one
    with at least ``covered`` percent of its count is dropped.
    """
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.col(text_col).cast("string").alias("t__"))
    segments = arrow_map(texts, cut_segments, "lang string, lead int, tokens binary, words array<string>, counts array<long>")
    segments = write_and_read(segments.withColumn("segment", F.monotonically_increasing_id()), "segments")
    listed = segments.select("lang", F.inline(F.arrays_zip("words", "counts")))
    words = write_and_read(listed.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = write_and_read(dense_keys(words.where(F.col("f") >= least), ["word", "lang"], "id"), "frequent-words")
    counted = count_phrases(segments, frequent, least)
    kept = undominated(counted, covered)
    scored = score(kept, counted, frequent)

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("at", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(
        F.col("at") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top)
    return best.join(totals.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of one language each: tokens as numbers (of 2 or 4 bytes) into the segment's words, 0 between pieces."""
    for b in slices(batches, "t__", SEGMENT_BYTES):
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("t__"))):
            by_lang.setdefault(lang, []).append(text.translate(TABLE))
        for lang, found in by_lang.items():
            text, at, lead = b".".join(found), 0, []
            while at < len(text):
                stop = GAPS.search(text, at + SEGMENT_BYTES)
                end = stop.start() if stop else len(text)
                tokens = text[at:end].replace(b".", b" . ").split()
                yield segment(lang, lead, tokens)
                at, lead = end, (lead + tokens)[1 - LONGEST:]


def segment(lang: str, lead: list[bytes], tokens: list[bytes]) -> pa.RecordBatch:
    index = {b".": 0}
    numbers = np.array([index.setdefault(t, len(index)) for t in lead + tokens], dtype=np.int32)
    counts = np.bincount(numbers[len(lead):], minlength=len(index))[1:]
    words = pa.array(list(index)[1:], pa.binary()).cast(pa.string())
    numbers = numbers.astype(token_type(len(words)))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.array([len(lead)], pa.int32()), pa.array([numbers.tobytes()], pa.binary()),
         pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
         pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(counts, pa.int64()))],
        names=["lang", "lead", "tokens", "words", "counts"])


def token_type(words: int) -> type:
    """Numbers of a segment with so many words."""
    return np.uint16 if words < 1 << 16 else np.int32


def count_phrases(segments: DataFrame, frequent: DataFrame, least: int) -> DataFrame:
    """(w, a): word ids and exact count of each phrase of two to four words with a >= ``least``."""
    ids, total = frequent.agg(F.max("id"), F.sum("f")).first()
    if (ids or 0) >= 1 << 31:
        raise ValueError(f"{ids} frequent words; ids of 31 bits are the most that two halves of 64 bits can hold")
    layout = Layout(max(1, int(ids or 0).bit_length()), 3 * int(total or 0), 8 * task_count(segments))
    own = segments.select("segment", "lang", F.posexplode("words").alias("at", "own"))
    known = own.join(frequent.select(F.col("lang").alias("of"), "word", "id"),
                     (F.col("lang") == F.col("of")) & (F.col("own") == F.col("word")))
    known = known.groupBy(F.col("segment").alias("s")).agg(
        F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "id")).alias("pairs"))  # at most the words of one segment
    coded = segments.select("segment", "lead", "tokens", F.size("words").alias("words")).join(
        known, F.col("segment") == F.col("s")).select("lead", "tokens", "words", F.transform("pairs", lambda p: p["at"]).alias("at"),
        F.transform("pairs", lambda p: p["id"]).alias("id"))
    filters = arrow_map(coded, lambda bs: build(bs, layout),
                        "block long, entries long, runs binary, rest binary, counters binary, large binary")
    filters = filters.repartition(task_count(segments), "block").sortWithinPartitions("block")
    counted = arrow_map(filters, lambda bs: merge(bs, layout, least), "w1 long, w2 long, w3 long, w4 long, a long")
    w = F.filter(F.array("w1", "w2", "w3", "w4"), lambda x: x > 0)
    return write_and_read(counted.select(w.alias("w"), "a"), "phrases")


class Layout:
    """Widths of a filter's fields, the same for all tasks: halves, blocks, quotients, remainder."""

    def __init__(self, bits: int, phrases: int, least_blocks: int):
        self.bits, self.half = bits, 2 * bits
        blocks = max(least_blocks, -(-phrases // FILTER_ENTRIES))
        self.block = min(self.half, (blocks - 1).bit_length())
        self.quotient = min(self.half - self.block, max(0, (FILTER_ENTRIES >> self.block).bit_length() - 1))
        self.rest = self.half - self.block - self.quotient
        self.one = self.rest + self.half <= 64  # the remainder as one number, or as the left half's rest and the right half
        self.widths = [-(-(self.rest + self.half) // 8)] if self.one else [-(-self.rest // 8), -(-self.half // 8)]

    def mix(self, x: np.ndarray, key: int) -> np.ndarray:
        h = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return (h ^ (h >> np.uint64(29))) & np.uint64((1 << self.half) - 1)

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in ROUND_KEYS:
            left, right = right, left ^ self.mix(right, key)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(ROUND_KEYS):
            left, right = right ^ self.mix(left, key), left
        return left, right

    def order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """An order by block and quotient in which equal pairs are neighbours."""
        lost = max(0, 2 * self.half - 64)
        whole = (left << np.uint64(min(self.half, 64 - self.half))) | (right >> np.uint64(lost))
        order = np.argsort(whole)
        if lost:  # different pairs may agree in the leading 64 bits
            w, r = whole[order], right[order]
            same = w[1:] == w[:-1]
            mixed = same & (r[1:] != r[:-1])
            if mixed.any():
                run = np.cumsum(np.r_[False, ~same])
                among = np.isin(run, run[1:][mixed])
                part = order[among]
                order[among] = part[np.lexsort((right[part], run[among]))]
        return order

    def tally(self, left: np.ndarray, right: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in order and the sums of their counts (one each by default)."""
        if not len(left):
            return left, right, np.zeros(0, dtype=np.int64)
        if count is None and 2 * self.half < 64:
            whole = np.sort((left << np.uint64(self.half)) | right)
            first = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]])
            kept = whole[first]
            left, right = kept >> np.uint64(self.half), kept & np.uint64((1 << self.half) - 1)
            return left, right, np.diff(np.r_[first, len(whole)])
        order = self.order(left, right)
        left, right = left[order], right[order]
        first = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
        sums = np.diff(np.r_[first, len(order)]) if count is None else np.add.reduceat(count[order], first)
        return left[first], right[first], sums

    def remainders(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        low = left & np.uint64((1 << self.rest) - 1)
        if self.one:
            return low_bytes((low << np.uint64(self.half % 64)) | right if self.rest else right, self.widths[0])
        return np.concatenate([low_bytes(low, self.widths[0]), low_bytes(right, self.widths[1])], axis=1)

    def halves(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The left half's rest and the right half of remainders."""
        if self.one:
            whole = number(rest)
            if not self.rest:
                return np.zeros(len(whole), np.uint64), whole
            return whole >> np.uint64(self.half), whole & np.uint64((1 << self.half) - 1)
        return number(rest[:, :self.widths[0]]), number(rest[:, self.widths[0]:])


class Held:
    """Entries that a task holds: runs of distinct entries, added up when they have grown."""

    def __init__(self, layout: Layout):
        self.layout, self.runs, self.size = layout, [], 0

    def add(self, run: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.runs.append(run)
        self.size += len(run[0])

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries, each once; they stay held."""
        if len(self.runs) != 1:
            none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
            self.runs = [self.layout.tally(*(np.concatenate(x) for x in zip(none, *self.runs)))]
            self.size = len(self.runs[0][0])
        return self.runs[0]

    def clear(self) -> None:
        self.runs, self.size = [], 0


def build(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Counts the phrases of segments; emits filters whenever ``FILTER_ENTRIES`` different ones are held."""
    held = Held(layout)
    for b in batches:
        for i in range(b.num_rows):
            at, ids = (np.array(b.column(c)[i].values, dtype=np.int64) for c in ("at", "id"))
            words = b.column("words")[i].as_py()
            tokens = np.frombuffer(b.column("tokens")[i].as_buffer(), dtype=token_type(words))
            of_word = np.zeros(words + 1, dtype=np.uint64)
            of_word[at + 1] = ids.astype(np.uint64)
            held.add(layout.tally(*layout.permute(*phrases(of_word[tokens], b.column("lead")[i].as_py(), layout)), None))
            if held.size >= FILTER_ENTRIES and len(held.settle()[0]) >= FILTER_ENTRIES:
                yield from encode(*held.settle(), layout)
                held.clear()
    yield from encode(*held.settle(), layout)


def phrases(ids: np.ndarray, lead: int, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Halves of all phrases of two to four words without a zero whose last word comes after the first ``lead``."""
    left, right, bits = [], [], np.uint64(layout.bits)
    for n in range(2, LONGEST + 1):
        if len(ids) < n:
            break
        w = [ids[k:len(ids) - n + 1 + k] for k in range(n)]
        whole = reduce(np.logical_and, [x > 0 for x in w])
        whole[:max(0, lead - n + 1)] = False
        w = [x[whole] for x in w] + [np.zeros(int(whole.sum()), np.uint64)] * (LONGEST - n)
        left.append((w[0] << bits) | w[1])
        right.append((w[2] << bits) | w[3])
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def encode(left: np.ndarray, right: np.ndarray, count: np.ndarray, layout: Layout) -> Iterator[pa.RecordBatch]:
    """One filter for each block that sorted entries touch."""
    if not len(left):
        return
    slots = 1 << layout.quotient
    top = (left >> np.uint64(layout.rest)).astype(np.int64)  # block and quotient
    block, quotient = top >> layout.quotient, top & (slots - 1)
    first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    sizes = np.diff(np.r_[first, len(block)])
    # unary runs: a one for each entry, a zero after each quotient; whole bytes for each filter
    row = np.repeat(np.arange(len(first)), sizes)
    run_bytes = -(-(sizes + slots) // 8)
    run_start = np.r_[0, np.cumsum(run_bytes)]
    ones = run_start[row] * 8 + quotient + np.arange(len(block)) - first[row]
    bits = np.zeros(int(run_start[-1]) * 8, dtype=np.uint8)
    bits[ones] = 1
    runs = np.packbits(bits)
    rest = layout.remainders(left, right)
    big = count >= 255
    large = np.where(big, count, 0)[big]
    large_start = np.r_[0, np.cumsum(np.add.reduceat(big.astype(np.int64), first))]
    width = sum(layout.widths)
    yield pa.RecordBatch.from_arrays(
        [pa.array(block[first]), pa.array(sizes), cut_bytes(runs, run_start),
         cut_bytes(rest.ravel(), np.r_[first, len(block)] * width),
         cut_bytes(np.minimum(count, 255).astype(np.uint8), np.r_[first, len(block)]),
         cut_bytes(large.astype("<i8").view(np.uint8), large_start * 8)],
        names=["block", "entries", "runs", "rest", "counters", "large"])


def low_bytes(x: np.ndarray, width: int) -> np.ndarray:
    return x.astype("<u8").view(np.uint8).reshape(len(x), 8)[:, :width]


def cut_bytes(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array whose values lie between ``offsets`` of ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def joined_bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)


def decode(b: pa.RecordBatch, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of a batch of filters, each filter in its order."""
    sizes, block = b.column("entries").to_numpy(), b.column("block").to_numpy()
    slots = 1 << layout.quotient
    used = sizes + slots
    run_start = 8 * np.r_[0, np.cumsum(-(-used // 8))]
    bits = np.unpackbits(joined_bytes(b.column("runs")))
    inside = np.repeat(run_start[:-1] - np.r_[0, np.cumsum(used)][:-1], used) + np.arange(used.sum())
    bits = bits[inside]  # without the padding; each filter has one zero for each of its quotients
    ones = np.flatnonzero(bits)
    row = np.repeat(np.arange(len(sizes)), sizes)
    quotient = ones - np.arange(len(ones)) - row * slots
    low, right = layout.halves(joined_bytes(b.column("rest")).reshape(len(ones), sum(layout.widths)))
    left = (block[row].astype(np.uint64) << np.uint64(layout.quotient)) | quotient.astype(np.uint64)
    left = (left << np.uint64(layout.rest)) | low
    count = joined_bytes(b.column("counters")).astype(np.int64)
    count[count == 255] = joined_bytes(b.column("large")).view("<i8")
    return left, right, count


def number(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data), 8), dtype=np.uint8)
    out[:, :data.shape[1]] = data
    return out.view("<u8").ravel().astype(np.uint64)


def merge(batches: Iterator[pa.RecordBatch], layout: Layout, least: int) -> Iterator[pa.RecordBatch]:
    """Adds the filters of each block, which come one after another; frequent entries as word ids."""
    held, shift = Held(layout), np.uint64(layout.half - layout.block)

    def finished(left: np.ndarray, right: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        often = count >= least
        left, right = layout.restore(left[often], right[often])
        bits, low = np.uint64(layout.bits), np.uint64((1 << layout.bits) - 1)
        ids = [left >> bits, left & low, right >> bits, right & low]
        return pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int64)) for x in ids], pa.array(count[often])],
                                          names=["w1", "w2", "w3", "w4", "a"])

    waiting = 0
    for whole in batches:
        for b in (whole.slice(s, 64) for s in range(0, whole.num_rows, 64)):
            made = layout.tally(*decode(b, layout))
            held.add(made)
            waiting += len(made[0])
            if waiting < FILTER_ENTRIES:
                continue
            waiting = 0
            entries = held.settle()
            held.clear()
            going = entries[0] >> shift == np.uint64(b.column("block")[b.num_rows - 1].as_py())  # may have more filters
            held.add(tuple(x[going] for x in entries))
            if not going.all():
                yield finished(*(x[~going] for x in entries))
    if held.size:
        yield finished(*held.settle())


def part(first: int, length: int) -> Column:
    return F.slice("w", first, length)


def undominated(counted: DataFrame, covered: int) -> DataFrame:
    """Phrases without those inside a longer phrase that has at least ``covered`` percent of their count."""
    n = F.size("w")
    inner = F.filter(F.array(*[F.when((n > length) & (n >= first + length - 1), part(first, length))
                               for length in range(2, LONGEST) for first in range(1, LONGEST - length + 2)]),
                     lambda x: x.isNotNull())
    longer = counted.where(F.size("w") > 2).select(F.explode(inner).alias("inner"), "a").groupBy("inner").agg(
        F.max("a").alias("longer"))
    whole = F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(20,0)")
    dropped = F.coalesce(whole >= F.lit(covered).cast("decimal(3,0)") * F.col("a").cast("decimal(20,0)"), F.lit(False))
    return counted.join(longer, F.col("w") == F.col("inner"), "left").where(~dropped).select("w", "a")


def score(kept: DataFrame, counted: DataFrame, frequent: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of each kept phrase by its lowest-scoring cut."""
    def use(role: str, at: int, key: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), F.lit(at).alias("at"), key.alias("key"))

    n = F.size("w")
    uses = [F.when(n >= k, use("word", k, part(k, 1))) for k in range(1, LONGEST + 1)]
    uses += [F.when(n > k, use("first", k, part(1, k))) for k in range(2, LONGEST)]
    uses += [F.when(n > k + 1, use("rest", k, F.slice("w", k + 1, n - k))) for k in range(1, LONGEST - 1)]
    uses = kept.withColumn("phrase", F.monotonically_increasing_id()).select(
        "phrase", n.alias("n"), "a", F.explode(F.filter(F.array(*uses), lambda x: x.isNotNull())).alias("u"))
    uses = write_and_read(uses.select("phrase", "n", "a", "u.role", "u.at", "u.key"), "phrase-parts")
    table = counted.select(F.col("w").alias("key__"), F.col("a").alias("f"), F.lit(None).cast("string").alias("word"),
                           F.lit(None).cast("string").alias("lang")).unionByName(
        frequent.select(F.array("id").alias("key__"), "f", "word", "lang"))
    found = lookup(uses, table, "key")

    def of(role: str, at: int, value: str = "f") -> Column:
        return F.max(F.when((F.col("role") == role) & (F.col("at") == at), F.col(value)))

    whole = found.groupBy("phrase").agg(
        F.max("n").alias("n"), F.max("a").alias("a"), F.max("lang").alias("lang"),
        *[of("word", k).alias(f"f{k}") for k in range(1, LONGEST + 1)],
        *[of("word", k, "word").alias(f"word{k}") for k in range(1, LONGEST + 1)],
        *[of("first", k).alias(f"first{k}") for k in range(2, LONGEST)],
        *[of("rest", k).alias(f"rest{k}") for k in range(1, LONGEST - 1)])
    last = F.get(F.array(*[F.col(f"f{k}") for k in range(1, LONGEST + 1)]), F.col("n") - 1)
    cuts = []
    for k in range(1, LONGEST):
        left = F.col("f1") if k == 1 else F.col(f"first{k}")
        right = F.when(F.col("n") == k + 1, last)
        if k < LONGEST - 1:
            right = right.otherwise(F.col(f"rest{k}"))
        cuts.append((k, left, right))
    wide = whole.withColumns({f"l{k}": left for k, left, _ in cuts} | {f"r{k}": right for k, _, right in cuts})
    exact = "CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l{k} AS DECIMAL(20,0)) + CAST(r{k} AS DECIMAL(20,0)))"
    options = F.array(*[F.when(F.col("n") > k, F.struct(
        F.expr(exact.format(k=k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k, _, _ in cuts])
    best = F.array_min(F.filter(options, lambda x: x.isNotNull()))
    text = F.concat_ws(" ", *[F.col(f"word{k}") for k in range(1, LONGEST + 1)])
    return wide.select("lang", text.alias("phrase"), "a", best.alias("best")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score")
