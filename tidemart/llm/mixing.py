"""Mixing sources to target weights by subset-sum over exact document sizes.

The size of a document is its number of words. A source's target is its share
of all sizes by weight, at most ``max_repeat`` times its own size (the excess
goes to the others by weight). Whole repeats of a source are taken as often as
they fit; what remains of its budget is filled by single documents:

1. documents are counted by (source, size) - partially aggregated, and never
   more rows than there are different sizes,
2. per source, every size gives the same fraction of its documents as the
   budget is of the source, rounded down, so that the selection looks like the
   source; larger sizes are then added while they fit until at most ``exact``
   words are open, and a bounded-knapsack table over these (sizes with their
   remaining counts, split in powers of two) gives the sum nearest to the
   budget,
3. of each (source, size) the wanted number of documents is selected in the
   order of a seeded hash. The order is not kept in one window: documents are
   first counted in hash buckets of about a thousand, and only the bucket that
   the limit falls into is numbered.

Reruns agree, as ties are ordered by id and text. Weights repeat 5, 2, 1 over
the sources in code point order, null last.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own; a source of size 0 has target 0; null ids and
repeated rows count one by one; an empty table gives no rows; columns named in
``carry`` pass through, others are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import write_and_read
from tidemart.operators.keys import dense_keys
from tidemart.session import share_code

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
EXACT = 1 << 16


def word_count(text_col: str) -> Column:
    """Runs of characters other than the six ASCII white space characters."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(squeezed == "", 0).otherwise(
        F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))) + 1).cast("long")


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 42,
                exact: int = EXACT, carry: Sequence[str] = ()) -> DataFrame:
    """id, carry..., size, source_size, target, copies, taken: one row per input row."""
    extra = [F.col(c).alias(f"x{i}__") for i, c in enumerate(carry)]
    rows = df.select(F.col(id_col).alias("id__"), *extra, F.col(source_col).alias("source__"),
                     word_count(text_col).alias("size"),
                     F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("order__"))
    rows = write_and_read(rows, "mix-rows")
    counts = rows.groupBy("source__", "size").agg(F.count(F.lit(1)).alias("n"))
    counts = write_and_read(counts, "mix-counts")
    goals = source_targets(counts, weights, max_repeat)
    share_code(df.sparkSession)
    plan = counts.join(goals.withColumnRenamed("source__", "s"), F.col("source__").eqNullSafe(F.col("s"))).select(
        "source__", F.col("size").alias("size_p"), "n", "source_size", "target")
    plan = plan.groupBy("source__").applyInPandas(
        lambda p: fit_budget(p, exact, max_repeat), "source__ string, size_p long, n long, source_size long, target double, "
                                        "whole long, pick long")
    plan = write_and_read(plan.withColumnRenamed("source__", "s"), "mix-plan")
    # selection by seeded order, in buckets of about a thousand rows of one (source, size)
    span = F.greatest(F.lit(1), F.ceil(F.col("n") / 1000)).cast("long")
    unit = F.shiftrightunsigned(F.col("order__"), 1) / F.lit(float(1 << 63))
    dealt = rows.join(plan, F.col("source__").eqNullSafe(F.col("s")) & (F.col("size") == F.col("size_p"))).withColumn(
        "bucket__", F.floor(unit * span).cast("long"))
    group = ["source__", "size", "bucket__"]
    seen = dealt.groupBy(*group).agg(F.count(F.lit(1)).alias("in_bucket"), F.first("pick").alias("pick_b"))
    before = Window.partitionBy("source__", "size").orderBy("bucket__")
    cut = seen.withColumn("before", F.sum("in_bucket").over(before) - F.col("in_bucket")).where(
        "before < pick_b").select(F.col("source__").alias("s_b"), F.col("size").alias("size_b"),
                                  F.col("bucket__").alias("b_b"), (F.col("pick_b") - F.col("before")).alias("open"),
                                  "in_bucket")
    marked = dealt.join(cut, F.col("source__").eqNullSafe(F.col("s_b")) & (F.col("size") == F.col("size_b"))
                        & (F.col("bucket__") == F.col("b_b")), "left")
    inside = F.col("open").isNotNull() & (F.col("open") < F.col("in_bucket"))
    numbered = marked.where(inside).withColumn("line", F.row_number().over(
        Window.partitionBy(*group).orderBy("order__", "id__")))
    chosen = marked.where(~inside).withColumn("line", F.lit(1)).unionByName(numbered)
    copies = F.col("whole") + F.when(F.col("open").isNotNull() & (F.col("line") <= F.col("open")), 1).otherwise(0)
    return chosen.select(F.col("id__").alias(id_col), *(F.col(f"x{i}__").alias(c) for i, c in enumerate(carry)),
                         "size", "source_size", "target", copies.alias("copies"),
                         (F.col("size") * copies).alias("taken"))


def source_targets(counts: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source__, source_size, target; one row per source.

    Sources are numbered over fixed ranges of their order, on all tasks, however
    many there are.
    """
    sizes = counts.groupBy("source__").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).withColumn(
        "none__", F.col("source__").isNull())
    numbered = dense_keys(write_and_read(sizes, "mix-sources"), ["none__", "source__"], "rank__", -1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                          (F.pmod(F.col("rank__"), F.lit(len(weights))) + 1).cast("int"))
    limit = (F.col("source_size") * max_repeat).cast("double")
    sources = write_and_read(numbered.select("source__", "source_size", weight.alias("weight"), limit.alias("limit")), "mix-sources")
    line = water_line(sources)
    return sources.select("source__", "source_size", F.least("limit", F.lit(line) * F.col("weight")).alias("target"))


def water_line(sources: DataFrame) -> float:
    """The line at which the sum of min(limit, line * weight) is the sum of all sizes.

    Newton's steps from below: those that a line stops at their limit leave the
    rest to the others, which raises the line. The sum is concave and piecewise
    linear, so the steps end at the exact line, after a few sums in practice.
    """
    ratio = F.col("limit") / F.col("weight")
    start = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, line = float(start["size"] or 0), 0.0
    open_weight, stopped = start["weight"] or 0.0, 0.0
    while open_weight > 0 and (total - stopped) / open_weight > line:
        line = (total - stopped) / open_weight
        below = ratio < F.lit(line)
        sums = sources.agg(F.sum(F.when(below, F.col("limit")).otherwise(0.0)).alias("stopped"),
                           F.sum(F.when(below, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        stopped, open_weight = sums["stopped"], sums["open"]
    return line


def fit_budget(part: pd.DataFrame, exact: int = EXACT, max_repeat: int = MAX_REPEAT) -> pd.DataFrame:
    """For one source and each size: copies of all its documents, and how many documents get one more.

    A source whose whole target fits the table, and whose budget beyond whole
    repeats has no exact sum, is fitted from nothing, each document up to
    ``max_repeat`` times.
    """
    size, n = part["size_p"].to_numpy(np.int64), part["n"].to_numpy(np.int64)
    total, target = int(part["source_size"].iloc[0]), float(part["target"].iloc[0])
    whole = int(target // total) if total else 0
    budget = int(round(target - whole * total)) if total else 0
    pick = np.zeros(len(size), dtype=np.int64)
    if budget > 0:
        share = [c * budget // total if s else 0 for s, c in zip(size.tolist(), n.tolist())]
        pick = np.array(share, dtype=np.int64)
        rest = budget - int((pick * size).sum())
        for i in np.argsort(-size, kind="stable"):  # large sizes first until the table can hold the rest
            if rest <= exact:
                break
            if size[i]:
                more = min(int(n[i] - pick[i]), rest // int(size[i]), -(-(rest - exact) // int(size[i])))
                pick[i] += more
                rest -= more * int(size[i])
        pick += nearest_subset(size, n - pick, rest)
    copies = whole * n + pick
    if total and round(target) != (copies * size).sum() and target <= exact:
        anew = nearest_subset(size, n * max_repeat, int(round(target)))
        if abs((anew * size).sum() - target) < abs((copies * size).sum() - target):
            copies = anew
    return part.assign(whole=copies // n, pick=copies % n)[
        ["source__", "size_p", "n", "source_size", "target", "whole", "pick"]]


def nearest_subset(size: np.ndarray, n: np.ndarray, budget: int) -> np.ndarray:
    """Counts (at most ``n`` of each size) whose total is nearest to ``budget``, from below in a tie."""
    pick = np.zeros(len(size), dtype=np.int64)
    used = (size > 0) & (n > 0)
    if not used.any() or budget <= 0:
        return pick
    top = budget + int(min(size[used].max(), budget))  # a sum beyond this is not the nearest
    reach = np.zeros(top + 1, dtype=bool)
    reach[0] = True
    item_of = np.full(top + 1, -1, dtype=np.int64)
    items: list[tuple[int, int]] = []
    for i in np.argsort(-size, kind="stable"):
        if reach[budget]:
            break
        s = int(size[i])
        if s == 0 or s > top:
            continue
        left, k = min(int(n[i]), top // s), 1
        while left > 0 and not reach[budget]:
            take = min(k, left)
            step = take * s
            fresh = np.zeros_like(reach)
            fresh[step:] = reach[:top + 1 - step]
            fresh &= ~reach
            item_of[fresh] = len(items)
            items.append((int(i), take))
            reach |= fresh
            left -= take
            k *= 2
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, take = items[item_of[at]]
        pick[i] += take
        at -= take * int(size[i])
    return pick
