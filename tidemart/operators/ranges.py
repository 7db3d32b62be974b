"""Fixed ranges of an order: bounds from quantile sketches.

``repartitionByRange`` samples its bounds anew at every evaluation, so a row's
partition may change between two of them. Here the bounds are taken once, from
KLL sketches (one small aggregation), and become constants: a row's range is a
function of its values, equal in every branch of a plan and after every retry,
and nothing has to be written to pin it down.

Order columns are mapped to components, 64-bit integers in the same order. A
first component that holds more than its share of the rows (a hot key, a date
with a third of all rows) is divided by sketches of the next component within
its heavy values, and so on, so a range is large only where all components of
many rows are equal. Sketches err by a fraction of a range as long as their size
``k`` can grow with the number of ranges (to about 1600 ranges), beyond that by
about a range. There are at most ``MAX_RANGES`` ranges.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

LOWEST = -(1 << 63)
MAX_RANGES = 4096
"""Bounds are constants of the plan; a range of a larger table is larger, and its window spills."""
_CHUNK = 7  # bytes of a string in one component


def components(df: DataFrame, order_cols: Sequence[str]) -> list[Column]:
    """Integers whose order follows ``order_cols`` ascending, nulls first; rows may tie that the columns tell apart."""
    out: list[Column] = []
    for name in order_cols:
        found, exact = _of_column(F.col(name), df.schema[name].dataType)
        out += [F.coalesce(c, F.lit(LOWEST)) for c in found]
        if not exact:  # what follows would not be in order
            break
    return out


def _of_column(c: Column, kind: DataType) -> tuple[list[Column], bool]:
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType, BooleanType)):
        return [c.cast("bigint")], True
    if isinstance(kind, DateType):
        return [F.unix_date(c).cast("bigint")], True
    if isinstance(kind, TimestampType):
        return [F.unix_micros(c)], True
    if isinstance(kind, TimestampNTZType):
        start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return [F.timestamp_diff("MICROSECOND", start, c)], True
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return [(c * F.lit(10 ** kind.scale).cast(f"decimal({kind.scale + 1},0)")).cast("bigint")], True
    if isinstance(kind, (FloatType, DoubleType, DecimalType)):
        x = c.cast("double")
        edge = float(1 << 62)
        near = F.greatest(F.least(x, F.lit(edge)), F.lit(-edge)).cast("bigint")
        return [F.when(F.isnan(x), F.lit(1 << 62)).when(x.isNotNull(), near)], False
    if isinstance(kind, StringType):
        raw = c.cast("binary")
        return [F.conv(F.rpad(F.hex(F.substring(raw, s, _CHUNK)), 2 * _CHUNK, "0"), 16, 10).cast("bigint")
                for s in (1, 1 + _CHUNK)], False
    return [F.when(c.isNotNull(), F.lit(0).cast("bigint"))], False


def range_bounds(df: DataFrame, parts: Sequence[Column], n: int) -> list[list[int]]:
    """Lower bounds of the second to the last of about ``n`` ranges, ascending; each as long as ``parts``.

    One aggregation over ``df``, and one more over the rows of heavy values for
    each further component that is needed. At most about 2n numbers are collected.
    """
    n = min(n, MAX_RANGES)
    names = [f"_c{i}" for i in range(len(parts))]
    values = df.select(*[p.alias(c) for p, c in zip(parts, names)])
    k = min(65535, max(200, 40 * n))
    spark, bounds = df.sparkSession, set()
    total, heavy = 0, [()]
    for level, name in enumerate(names):
        prefix = names[:level]
        rows = values
        if prefix:
            same = spark.createDataFrame(heavy, ", ".join(f"{c} bigint" for c in prefix))  # at most n rows
            rows = rows.join(F.broadcast(same), prefix)
        found = rows.groupBy(*prefix).agg(F.count(F.lit(1)).alias("rows"),
                                          F.kll_sketch_agg_bigint(name, F.lit(k)).alias("sketch"))
        # a heavy value gets its share of the n ranges: every so many of the n - 1 quantiles
        cut = F.ceil(F.col("rows") * n / F.lit(max(total, 1))).cast("int") if level else F.lit(n)
        quantiles = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(i / n) for i in range(1, max(n, 2))]))
        picked = F.transform(F.sequence(F.lit(1), cut - 1),
                             lambda i: F.get(F.col("quantiles"), (F.round(i * n / cut) - 1).cast("int")))
        got = found.where("rows > 0").withColumn("quantiles", quantiles).select(
            *prefix, "rows", F.when(cut > 1, picked).alias("quantiles")).collect()
        if not level:
            total = got[0]["rows"] if got else 0
        heavy = []
        for r in got:
            at = tuple(r[c] for c in prefix)
            q = r["quantiles"] or []
            for i, v in enumerate(q):
                bounds.add((*at, v))
                if i and v == q[i - 1] and (not heavy or heavy[-1] != (*at, v)):
                    heavy.append((*at, v))
        if not heavy or not total:
            break
    padded = {(*b, *[LOWEST] * (len(names) - len(b))) for b in bounds}
    return [list(b) for b in sorted(padded)]


def range_of(parts: Sequence[Column], bounds: list[list[int]]) -> Column:
    """Number of a row's range, from 0: how many bounds are not above it (binary search)."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(bounds)), "array<array<bigint>>")  # folded to a constant
    row, n = F.array(*parts), len(bounds)
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(table, at + step - 1) <= row), at + step).otherwise(at))
