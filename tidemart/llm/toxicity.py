"""Toxicity as graded severity by cumulative-link ordinal regression.

P(grade <= j) = sigmoid(theta_j - w.x): one weight vector for all thresholds,
which are ordered. x holds the log counts of sparse text features, words and
word beginnings of 4 and 5 letters. The output is the expected grade and the
probability of any toxicity, for every document; ``toxic`` marks those whose
probability reaches ``threshold``.

Fitting uses a bounded sample of labelled documents, ``per_class`` toxic and as
many clean ones (the smallest seeded hashes of their ids, sent to all tasks by
their ids alone); each class is weighted back to its share of all labels.
Features are those most associated with toxic documents of the sample (a score
test); a feature must follow several different words, as near-copies of one
toxic text would otherwise lend it their whole vocabulary. Equal texts count
once. Newton steps sum gradient and Hessian over the sample in tasks.

Labels of 0 and 1 alone carry no severity: toxic documents are then graded by
how many words with a selected feature they hold (``steps``: 1, 2, 3). Labels
with more grades are used as they are.

All documents are scored whole in one pass without a shuffle.

Defined cases: a null or empty text has no features; a null id or one without
label is only scored; several labels of one id count as their rounded mean;
without toxic or without clean labels every score is 0; repeated rows get equal
scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import arrow_map, map_texts, slices, utf8, write_and_read
from tidemart.llm.newton import distributed_sum, matrix, sigmoid

WORD = re.compile(r"[^\W\d_]+")
PER_CLASS = 3000
FEATURES = 256
PREFIXES = (4, 5)
THRESHOLD = 0.3  # probability from which a document is flagged: a missed one costs more than a review
STEPS = (3, 6)  # up to 3 marked words: grade 1, up to 6: grade 2, more: grade 3

OUT = T.StructType([T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
                    T.StructField("severity", T.IntegerType()), T.StructField("toxic", T.BooleanType())])


def word_features(word: str) -> list[str]:
    return [word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]


@dataclass
class Ordinal:
    """Weights and ordered thresholds over a fixed list of features."""

    names: list[str]
    theta: np.ndarray
    weights: np.ndarray
    threshold: float = THRESHOLD

    def vectors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Log counts of the features, and the number of words that have one."""
        place = {f: i for i, f in enumerate(self.names)}
        x, marked = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), dtype=np.int64)
        memo: dict[str, tuple[int, ...]] = {}
        for row, t in enumerate(texts):
            for w, c in Counter(WORD.findall(t.decode("utf-8", "replace").lower())).items():
                hits = memo.get(w)
                if hits is None:
                    if len(memo) > 200_000:
                        memo.clear()
                    hits = memo[w] = tuple(place[f] for f in word_features(w) if f in place)
                if hits:
                    marked[row] += c
                    for i in hits:
                        x[row, i] += c
        return np.log1p(x), marked

    def grades(self, texts: list[bytes]) -> dict:
        if not self.names:
            zero = np.zeros(len(texts))
            return {"expected_severity": zero, "p_toxic": zero, "severity": zero.astype(np.int32), "toxic": zero > 0}
        above = 1 - sigmoid(self.theta[None, :] - (self.vectors(texts)[0] @ self.weights)[:, None])
        likely = -np.diff(np.c_[np.ones(len(texts)), above, np.zeros(len(texts))], axis=1)
        return {"expected_severity": above.sum(axis=1), "p_toxic": above[:, 0],
                "severity": likely.argmax(axis=1).astype(np.int32), "toxic": above[:, 0] >= self.threshold}


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", **options) -> DataFrame:
    """id, expected_severity, p_toxic, severity (likeliest grade), toxic: one row per input row."""
    model = fit(df, labels, id_col, text_col, label_col, **options)
    return map_texts(df, [id_col], text_col, model.grades, OUT)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = PER_CLASS, features: int = FEATURES, steps: Sequence[int] = STEPS, ridge: float = 0.5,
        rounds: int = 10, seed: int = 42, threshold: float = THRESHOLD) -> Ordinal:
    nothing = Ordinal([], np.zeros(1), np.zeros(0), threshold)
    truth = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("l__")).agg(F.round(F.avg(label_col)).cast("int").alias("y"))
    truth = write_and_read(truth.where("y >= 0"), "toxicity-labels")
    totals = {bool(r["t"]): r["n"] for r in truth.groupBy((F.col("y") > 0).alias("t")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return nothing
    order = F.xxhash64(F.lit(seed), F.col("l__"))
    picked = truth.where("y > 0").orderBy(order, "l__").limit(per_class).unionByName(
        truth.where("y = 0").orderBy(order, "l__").limit(per_class))
    texts = df.select(F.col(id_col).alias("id__"), F.col(text_col).cast("string").alias("text__"))
    sample = texts.join(F.broadcast(picked), F.col("id__") == F.col("l__")).select("text__", "y")
    sample = write_and_read(sample.withColumn("h__", F.xxhash64("text__")).dropDuplicates(["h__", "y"]), "toxicity-sample")
    in_class = {bool(r["t"]): (r["n"], r["top"]) for r in sample.groupBy((F.col("y") > 0).alias("t")).agg(
        F.count(F.lit(1)).alias("n"), F.max("y").alias("top")).collect()}
    if len(in_class) < 2:
        return nothing
    toxic, clean = in_class[True][0], in_class[False][0]
    names = associated(sample, toxic, clean, features)
    if not names:
        return nothing
    top = max(in_class[True][1], 1)
    given = top > 1
    k = top if given else len(steps) + 1
    model = Ordinal(names, np.zeros(k), np.zeros(len(names)), threshold)
    rows = write_and_read(vectors(sample, model, given, steps), "toxicity-vectors")
    weight = {t: totals[t] / in_class[t][0] for t in (False, True)}
    return newton(rows, model, weight, ridge, rounds)


def associated(sample: DataFrame, toxic: int, clean: int, limit: int) -> list[str]:
    """Features with the highest score statistics for toxic documents."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__", 1 << 20):
            feature, before, is_toxic, first = [], [], [], []
            for t, y in zip(utf8(b.column("text__")), b.column("y").to_pylist()):
                words = WORD.findall(t.decode("utf-8", "replace").lower())
                pairs = {(f, p if y > 0 else "") for w, p in zip(words, ["", *words]) for f in word_features(w)}
                seen: set[str] = set()
                for f, p in pairs:
                    feature.append(f)
                    before.append(p)
                    is_toxic.append(y > 0)
                    first.append(f not in seen)
                    seen.add(f)
            yield pa.RecordBatch.from_arrays([pa.array(feature, pa.string()), pa.array(before, pa.string()),
                                              pa.array(is_toxic, pa.bool_()), pa.array(first, pa.bool_())],
                                             names=["feature", "before", "toxic", "first"])

    found = arrow_map(sample.select("text__", "y"), emit, "feature string, before string, toxic boolean, first boolean")
    least = max(3, toxic // 200)
    counts = found.groupBy("feature", "before").agg(
        F.sum(F.expr("int(toxic and first)")).alias("t"), F.sum(F.expr("int(not toxic and first)")).alias("c"),
        F.max("toxic").alias("toxic")).groupBy("feature").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum(F.expr("int(toxic)")).alias("places"))
    n = toxic + clean
    rate = (F.col("t") + F.col("c")) / n
    z = (F.col("t") - toxic * rate) / F.sqrt(rate * (1 - rate) * toxic * clean / n + 1e-9)
    best = counts.where((F.col("t") >= least) & (F.col("places") >= F.least(F.lit(10), F.greatest(F.lit(3), F.ceil(F.col("t") / 8))))).withColumn(
        "z", z).where((F.col("z") >= 3) & (F.col("t") * clean > 4 * F.col("c") * toxic)).orderBy(F.col("z").desc(), "feature").limit(limit)
    return sorted(r["feature"] for r in best.select("feature").collect())


def vectors(sample: DataFrame, model: Ordinal, given: bool, steps: Sequence[int]) -> DataFrame:
    """x and grade of the sample's texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text__"):
            x, marked = model.vectors(utf8(b.column("text__")))
            y = b.column("y").to_numpy()
            grade = y if given else np.where(y > 0, 1 + np.searchsorted(steps, marked, side="left"), 0)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())),
                                              pa.array(grade.astype(np.int32))], names=["x", "grade"])

    return arrow_map(sample.select("text__", "y"), run, "x array<double>, grade int")


def newton(rows: DataFrame, model: Ordinal, weight: dict[bool, float], ridge: float, rounds: int) -> Ordinal:
    """Newton steps on the penalised likelihood; a step that raises the loss or unorders the thresholds is halved."""
    k, d = len(model.theta), len(model.weights)
    share = weight[True] / (weight[True] + weight[False])
    p = np.concatenate([model.theta * 0 + np.linspace(1, 2, k) - 1 + np.log((1 - share) / share), model.weights])
    penalty = np.r_[np.full(k, 1e-6), np.full(d, ridge)]
    best, step, at = None, None, p
    for _ in range(rounds):
        total = distributed_sum(rows, lambda b: terms(b, at, k, weight), 1 + (k + d) + (k + d) ** 2)
        loss = total[0] + 0.5 * (penalty * at * at).sum()
        if best is not None and not loss <= best + 1e-9:
            step = step / 2
            at = p + step
            continue
        done = best is not None and best - loss < 1e-6 * (1 + abs(loss))
        p, best = at, loss
        if done:
            break
        gradient = total[1:1 + k + d] + penalty * p
        hessian = total[1 + k + d:].reshape(k + d, k + d) + np.diag(penalty)
        step = -np.linalg.solve(hessian, gradient)
        while (np.diff(p[:k] + step[:k]) <= 1e-3).any():
            step = step / 2
        at = p + step
    return Ordinal(model.names, p[:k], p[k:], model.threshold)


def terms(b: pa.RecordBatch, p: np.ndarray, k: int, weight: dict[bool, float]) -> np.ndarray:
    """Negative log likelihood, gradient and Hessian of the cumulative-link model over a batch."""
    d = len(p) - k
    x, y = matrix(b.column("x"), d), b.column("grade").to_numpy()
    m = np.where(y > 0, weight[True], weight[False])
    theta, eta, n = p[:k], x @ p[k:], len(y)
    upper = np.where(y < k, theta[np.minimum(y, k - 1)] - eta, 40.0)
    lower = np.where(y > 0, theta[np.maximum(y, 1) - 1] - eta, -40.0)
    fu, fl = sigmoid(upper), sigmoid(lower)
    inside = np.maximum(fu - fl, 1e-12)
    du, dl = fu * (1 - fu) * (y < k), fl * (1 - fl) * (y > 0)
    a, c = du / inside, -dl / inside  # first derivatives by upper and lower
    aa = du * (1 - 2 * fu) / inside - a * a
    cc = -dl * (1 - 2 * fl) / inside - c * c
    ac = -a * c
    e = np.zeros((n, k + d))  # derivative of upper and lower by the parameters
    g = np.zeros((n, k + d))
    line = np.arange(n)
    e[line, np.minimum(y, k - 1)] = y < k
    g[line, np.maximum(y, 1) - 1] = y > 0
    e[:, k:], g[:, k:] = -x, -x
    gradient = -(e.T @ (m * a) + g.T @ (m * c))
    cross = (e * (m * ac)[:, None]).T @ g
    hessian = -((e * (m * aa)[:, None]).T @ e + (g * (m * cc)[:, None]).T @ g + cross + cross.T)
    return np.r_[-(m * np.log(inside)).sum(), gradient, hessian.ravel()]
