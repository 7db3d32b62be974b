"""Quality scores by co-training a text-content view and a metadata view.

* The content view sees the words: how they repeat, their lengths and their
  hashed frequencies. The metadata view sees the page around them: source,
  language, length, lines and character classes.
* Both are logistic models, fitted by Newton steps whose sums run over all
  labelled rows (one fold in five is held out).
* In each round both views score all unlabelled documents; those that one view
  is sure of become pseudo-labels for the other, weighted so that each class
  of pseudo-labels weighs ``pseudo_weight`` times the labelled rows of it.
* The held-out fold calibrates the two views together: a logistic model over
  their log odds combines them, and scores all documents.

Nothing is sampled. Features are written once (a few hundred bytes a document);
each step is one pass over them that returns a vector of fixed length per task,
summed in groups before the driver.

Defined cases: a null or empty text has zero features; null metadata are a
value of their own; documents without a label or with a null id are unlabelled;
several labels of one id count as their rounded mean; without labels of both
classes every score is 0.5 and nothing is rejected; repeated rows get the same
score; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, slices, utf8, write_and_read
from tidemart.llm.newton import distributed_sum, logistic_term, matrix, sigmoid, solve, split_term

WORD_BUCKETS = 24
NAME_BUCKETS = 12
CONTENT = 9 + WORD_BUCKETS
META = 13 + 2 * NAME_BUCKETS
SURE = 0.95
FOLDS = 5


def character_classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sentence mark, 7 symbol."""
    table = np.zeros(256, dtype=np.int64)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                               b" \t\x0b\x0c\r", b"\n", b".,;:!?'\"()-", b"#*$%&|<>@^~=_+/\\{}[]`"), start=1):
        table[list(chars)] = k
    table[128:] = 1
    return table


CLASSES = character_classes()


def content_features(raw: bytes) -> list[float]:
    """What the words say: repetition, lengths, hashed frequencies."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * CONTENT
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=n)
    buckets = np.zeros(WORD_BUCKETS)
    for w, c in counts.items():
        buckets[zlib.crc32(w) % WORD_BUCKETS] += c
    ends = sum(c for w, c in counts.items() if CLASSES[w[-1]] == 7)
    alone = sum(c for w, c in counts.items() if CLASSES[w[0]] == 7)
    top = max(counts.values())
    return [1.0, np.log1p(n) / 5, len(counts) / n, np.sqrt(top / n), sizes.mean() / 5, float((sizes <= 3).mean()),
            float((sizes >= 15).mean()), ends / n, alone / n, *(buckets / n * 4)]


def meta_features(raw: bytes, names: Sequence[str | None]) -> list[float]:
    """What the page tells without its words: names, length, lines, character classes."""
    n = len(raw)
    share = np.bincount(CLASSES[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / max(n, 1) if n else np.zeros(8)
    lines = [x for x in raw.split(b"\n") if x]
    hashed = np.zeros(2 * NAME_BUCKETS)
    for i, x in enumerate(names):
        hashed[(i % 2) * NAME_BUCKETS + zlib.crc32(repr(x).encode()) % NAME_BUCKETS] = 1.0
    repeat = 1 - len(set(lines)) / len(lines) if lines else 0.0
    return [1.0, np.log1p(n) / 5, np.log1p(len(lines)) / 3, np.log1p(n / max(1, len(lines))) / 5, repeat,
            *(share * [1, 1, 5, 5, 5, 20, 5, 5]), *hashed]


@dataclass
class Model:
    """Weights of both views and of their combination."""

    content: np.ndarray = field(default_factory=lambda: np.zeros(CONTENT))
    meta: np.ndarray = field(default_factory=lambda: np.zeros(META))
    mix: np.ndarray = field(default_factory=lambda: np.zeros(3))

    def views(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.clip(a @ self.content, -12, 12), np.clip(b @ self.meta, -12, 12)

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        za, zb = self.views(a, b)
        return sigmoid(np.stack([np.ones(len(za)), za, zb], axis=1) @ self.mix)


def features(df: DataFrame, keep: list[str], text_col: str, meta_cols: Sequence[str]) -> DataFrame:
    """``keep``, a (content view) and b (metadata view)."""
    picked = df.select(*keep, F.col(text_col).cast("string").alias("text__"),
                       *(F.col(c).cast("string").alias(f"m{i}__") for i, c in enumerate(meta_cols)))
    schema = T.StructType([picked.schema[c] for c in keep] + [
        T.StructField(c, T.ArrayType(T.FloatType())) for c in ("a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__"):
            x, y = batch_features(b, len(meta_cols))
            kind = pa.list_(pa.float32())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(list(x), kind),
                                              pa.array(list(y), kind)], names=schema.names)

    return arrow_map(picked, run, schema)


def batch_features(b: pa.RecordBatch, n_meta: int) -> tuple[np.ndarray, np.ndarray]:
    raw = utf8(b.column("text__"))
    names = list(zip(*(b.column(f"m{i}__").to_pylist() for i in range(n_meta)))) if n_meta else [()] * len(raw)
    return (np.array([content_features(t) for t in raw], dtype=np.float32),
            np.array([meta_features(t, m) for t, m in zip(raw, names)], dtype=np.float32))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", meta_cols: Sequence[str] = ("source", "lang"), rounds: int = 2,
          first_steps: int = 6, steps: int = 3, sure: float = SURE, pseudo_weight: float = 0.5,
          ridge: float = 1.0) -> tuple[Model, DataFrame]:
    """The fitted model, and the features table (id, a, b, y) it was fitted on."""
    made = features(df.withColumn("id__", F.col(id_col)), ["id__"], text_col, meta_cols)
    truth = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("l__")).agg(F.round(F.avg(label_col)).cast("int").alias("y"))
    fold = F.when(F.col("y").isNotNull(), F.pmod(F.xxhash64("id__"), F.lit(FOLDS)).cast("int"))
    table = write_and_read(made.join(truth, F.col("id__") == F.col("l__"), "left").drop("l__")
                           .withColumn("fold", fold), "quality-features")
    model = Model()
    ridges = [np.r_[1e-6, np.full(d - 1, ridge)] for d in (CONTENT, META)]
    for r in range(rounds + 1):
        source = Model(model.content.copy(), model.meta.copy()) if r else None
        for _ in range(steps if r else first_steps):
            sums = distributed_sum(table, lambda b: step_terms(b, model, source, sure), 3 * (view_size(CONTENT) + view_size(META)))
            parts = np.split(sums, np.cumsum([view_size(CONTENT)] * 3 + [view_size(META)] * 2))
            for view, d in enumerate((CONTENT, META)):
                (g, h, n), *pseudo = [split_term(v, d) for v in parts[3 * view:3 * view + 3]]
                if not n:
                    return model, table
                for pg, ph, pn in pseudo:
                    if pn:
                        scale = pseudo_weight * n / 2 / pn
                        g, h = g + scale * pg, h + scale * ph
                w = solve(g, h, model.meta if view else model.content, ridges[view])
                if view:
                    model.meta = w
                else:
                    model.content = w
    for _ in range(first_steps):
        g, h, n = split_term(distributed_sum(table, lambda b: mix_terms(b, model), 3 + 9 + 1), 3)
        model.mix = solve(g, h, model.mix, np.full(3, 0.1))
    return model, table


def view_size(d: int) -> int:
    return d + d * d + 1


def step_terms(b: pa.RecordBatch, model: Model, source: Model | None, sure: float) -> np.ndarray:
    """Sums for both views: labelled rows outside the held-out fold, pseudo-labels 0, pseudo-labels 1."""
    x, z = matrix(b.column("a"), CONTENT), matrix(b.column("b"), META)
    y = b.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
    fold = b.column("fold").to_numpy(zero_copy_only=False).astype(np.float64)
    labelled, free = fold > 0, np.isnan(fold)
    balance = np.ones(len(y))
    out = []
    if source is not None:
        by_content, by_meta = (sigmoid(v) for v in source.views(x, z))
    for view, (rows, w) in enumerate(((x, model.content), (z, model.meta))):
        out.append(logistic_term(rows[labelled], y[labelled], w, balance[labelled]))
        for cls in (0, 1):
            if source is None:
                out.append(np.zeros(view_size(rows.shape[1])))
                continue
            other = by_content if view else by_meta
            pick = free & ((other >= sure) if cls else (other <= 1 - sure))
            out.append(logistic_term(rows[pick], np.full(int(pick.sum()), float(cls)), w, balance[pick]))
    return np.concatenate(out)


def mix_terms(b: pa.RecordBatch, model: Model) -> np.ndarray:
    """Sums for the calibration of both views' log odds on the held-out fold."""
    fold = b.column("fold").to_numpy(zero_copy_only=False).astype(np.float64)
    held = fold == 0
    za, zb = model.views(matrix(b.column("a"), CONTENT)[held], matrix(b.column("b"), META)[held])
    y = b.column("y").to_numpy(zero_copy_only=False).astype(np.float64)[held]
    return logistic_term(np.stack([np.ones(len(y)), za, zb], axis=1), y, model.mix, np.ones(len(y)))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = 0.5,
                  **options) -> DataFrame:
    """id, p_content, p_meta, score, kept: one row per input row."""
    model, table = train(df, labels, id_col, **options)
    schema = T.StructType([T.StructField(id_col, table.schema["id__"].dataType)] + [
        T.StructField(c, T.DoubleType()) for c in ("p_content", "p_meta", "score")] + [
        T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, z = matrix(b.column("a"), CONTENT), matrix(b.column("b"), META)
            za, zb = model.views(x, z)
            s = model.score(x, z)
            yield pa.RecordBatch.from_arrays([b.column("id__"), pa.array(sigmoid(za)), pa.array(sigmoid(zb)),
                                              pa.array(s), pa.array(s >= threshold)], names=schema.names)

    return arrow_map(table.select("id__", "a", "b"), run, schema)


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              meta_cols: Sequence[str] = ("source", "lang"), threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``df`` that the model keeps, all columns; scored in one pass without a join."""
    model, _ = train(df, labels, id_col, text_col, meta_cols=meta_cols, **options)
    columns = df.columns
    marked = df.select(*columns, F.col(text_col).cast("string").alias("text__"),
                       *(F.col(c).cast("string").alias(f"m{i}__") for i, c in enumerate(meta_cols)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__"):
            yield b.select(columns).filter(pa.array(model.score(*batch_features(b, len(meta_cols))) >= threshold))

    return arrow_map(marked, run, df.schema)
