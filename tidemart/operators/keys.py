"""Ordered logic over whole tables: surrogate keys, neighbours.

Rows are divided into fixed ranges of the order (``operators.ranges``), so a
window runs inside each range, on all tasks, and what lies across ranges is a
table of one row per range: the count of rows before it, or its first and last
row. That table is broadcast; its size is the number of ranges we chose, never
the data's. Ranges are functions of the values: every branch of a plan and every
retry sees the same ones, so nothing is written to pin them down. Both functions
read their input several times and expect it to be file-backed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.operators.ranges import components, range_bounds, range_of

_R = "_range"


def ranged(df: DataFrame, order_cols: Sequence[str], num_ranges: int | None = None) -> DataFrame:
    """``df`` with the number of each row's range; four ranges to a task even out what hashing puts together."""
    n = num_ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = components(df, order_cols)
    return df.withColumn(_R, range_of(parts, range_bounds(df, parts, n)))


def dense_keys(df: DataFrame, order_cols: Sequence[str], sk_col: str,
               base: int | Column = 0, num_buckets: int | None = None) -> DataFrame:
    """Append ``sk_col`` = base + 1.. in ``order_cols`` order (bigint).

    The numbers of ``base + row_number() OVER (ORDER BY ...)`` without a window
    over one partition: row numbers inside each range plus the rows of the
    ranges before it. ``num_buckets`` is the number of ranges.
    """
    rows = ranged(df, order_cols, num_buckets)
    before = Window.orderBy(_R).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(_R).agg(F.count(F.lit(1)).alias("_n")).select(
        _R, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    base_col = base if isinstance(base, Column) else F.lit(int(base))
    inside = F.row_number().over(Window.partitionBy(_R).orderBy(*order_cols))
    return (rows.withColumn("_i", inside).join(F.broadcast(offsets), _R)
                .withColumn(sk_col, (base_col + F.col("_off") + F.col("_i")).cast("bigint"))
                .drop(_R, "_i", "_off"))


def with_neighbors(df: DataFrame, key: str, order_cols: Sequence[str],
                   prev_cols: Sequence[str] = (), next_cols: Sequence[str] = (),
                   num_buckets: int | None = None) -> DataFrame:
    """``lag``/``lead`` of columns within ``key`` ordered by ``order_cols``,
    without a window per key.

    Inside a range of the (key, order) order the neighbours are the rows before
    and after; the first row of a range has the last row of the nearest range
    before it that has rows, the last one the first row of the next. A neighbour
    of another key counts as none. A key with a third of the data lies in many
    ranges instead of one window task, at one exchange.

    Adds ``_prev_<c>`` / ``_next_<c>`` columns. (key, order_cols) must be unique.
    """
    order = [key, *order_cols]
    rows = ranged(df, order, num_buckets)
    place = F.struct(*order)
    wanted = {"prev": list(prev_cols), "next": list(next_cols)}
    seen = {side: F.struct(F.col(key).alias("_k"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
            for side, cols in wanted.items()}
    ends = rows.groupBy(_R).agg(F.max_by(seen["prev"], place).alias("_last"), F.min_by(seen["next"], place).alias("_first"))
    by_range = Window.orderBy(_R)
    ends = ends.select(_R, F.lag("_last").over(by_range).alias("_left"), F.lead("_first").over(by_range).alias("_right"))
    inside = Window.partitionBy(_R).orderBy(*order)
    rows = rows.withColumns({"_p": F.lag(seen["prev"]).over(inside), "_n": F.lead(seen["next"]).over(inside)})
    rows = rows.join(F.broadcast(ends), _R)
    added = []
    for side, near, far in (("prev", "_p", "_left"), ("next", "_n", "_right")):
        found = F.coalesce(F.col(near), F.col(far))
        for i, c in enumerate(wanted[side]):
            added.append(F.when(found["_k"] == F.col(key), found[f"_v{i}"]).alias(f"_{side}_{c}"))
    return rows.select(*df.columns, *added)
