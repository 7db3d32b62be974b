"""Fixed ranges, the as-of join over them, and integrity checks by bitmaps."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import bitmaps, quality
from tidemart.operators.asof import as_of_join
from tidemart.operators.keys import dense_keys, ranged
from tidemart.operators.ranges import components, range_bounds, range_of
from tidemart.session import materialize


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# --- ranges ---------------------------------------------------------------------

KINDS = {
    "bigint": [-(1 << 63), -5, 0, 3, 7, (1 << 63) - 1, None],
    "date": [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(2026, 1, 1), dt.date(9999, 12, 31), None],
    "timestamp_ntz": [dt.datetime(1960, 1, 1), dt.datetime(2026, 1, 1, 0, 0, 0, 1), dt.datetime(2026, 1, 1), None],
    "decimal(10,2)": ["-5.25", "0.00", "0.01", "99999999.99", None],
    "double": [float("-inf"), -1e300, -1.5, 0.0, 0.5, 2.0, 1e300, float("inf"), float("nan"), None],
    "string": ["", "a", "ab", "abcdefg", "abcdefgh", "abcdefghijklmnop", "b", "é", "東", None],
    "boolean": [True, False, None],
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_components_follow_the_order(spark, kind):
    rows = [(i, str(v) if kind.startswith("decimal") and v is not None else v) for i, v in enumerate(KINDS[kind])]
    source = "string" if kind.startswith("decimal") else kind
    df = spark.createDataFrame(rows, f"i int, v {source}").select("i", F.col("v").cast(kind).alias("v"))
    got = df.select("i", "v", F.array(*components(df, ["v"])).alias("c")).orderBy(F.asc_nulls_first("v")).collect()
    parts = [r["c"] for r in got]
    assert parts == sorted(parts)
    if kind not in ("double", "string"):
        assert len({tuple(p) for p in parts}) == len(parts) or kind == "bigint"  # only null and the lowest long tie


def test_ranges_are_even_and_ordered_with_a_hot_value(spark):
    rnd = random.Random(1)
    rows = [(0 if i % 3 == 0 else rnd.randint(-10**12, 10**12), rnd.choice([5, 5, 5, rnd.randint(0, 10**6)]), i)
            for i in range(30000)]
    df = materialize(spark.createDataFrame(rows, "a long, b long, c long"), "test")
    got = ranged(df, ["a", "b", "c"], 40)
    sizes = [r["count"] for r in got.groupBy("_range").count().collect()]
    assert 38 <= len(sizes) <= 45 and max(sizes) <= 2 * len(rows) / 40
    spans = got.groupBy("_range").agg(F.min(F.struct("a", "b", "c")).alias("lo"), F.max(F.struct("a", "b", "c")).alias("hi"))
    spans = [(tuple(r["lo"]), tuple(r["hi"])) for r in spans.orderBy("_range").collect()]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_ranges_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "k string")
    assert range_bounds(empty, components(empty, ["k"]), 8) == []
    same = materialize(spark.createDataFrame([("x",)] * 50, "k string"), "test")
    parts = components(same, ["k"])
    assert {r[0] for r in same.select(range_of(parts, range_bounds(same, parts, 8))).collect()} == {
        r[0] for r in same.select(range_of(parts, range_bounds(same, parts, 8))).limit(1).collect()}


def test_dense_keys_over_dates_and_strings_without_a_write(spark):
    rnd = random.Random(4)
    rows = [(dt.date(2026, rnd.randint(1, 3), 1), f"key-{rnd.randint(0, 10**6)}-{i}") for i in range(4000)]
    df = materialize(spark.createDataFrame(rows, "d date, k string"), "test")
    got = dense_keys(df, ["d", "k"], "sk", base=7, num_buckets=16)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("d", "k")) + 7)
    assert got.join(ref, ["d", "k"]).where("sk <> ref").count() == 0 and got.count() == len(rows)
    plan = plan_of(got)  # the shuffle of the window is by range; one partition sees the ranges' counts only
    assert "hashpartitioning(_range" in plan and "BroadcastHashJoin" in plan and "rangepartitioning" not in plan


# --- as-of join ---------------------------------------------------------------

def brute(rows, versions, extend):
    out = []
    for i, key, day in rows:
        mine = sorted((v for v in versions if v[0] == key and v[0] is not None and v[1] is not None), key=lambda v: v[1])
        before = [v for v in mine if day is not None and v[1] <= day]
        hit = before[-1] if before else mine[0] if extend and mine and day is not None else None
        out.append((i, hit[2] if hit else None))
    return sorted(out)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_as_of_equals_brute_force(spark, kind):
    rnd = random.Random(11)
    start = dt.date(2026, 1, 1)
    name = (lambda k: k) if kind == "long" else (lambda k: f"k{k}")
    days = lambda: start + dt.timedelta(days=rnd.randint(0, 400))
    versions = {(0, start + dt.timedelta(days=50 + d)) for d in range(300)}
    versions |= {(rnd.randint(1, 40), days()) for _ in range(150)}
    versions = [(name(k), d, n) for n, (k, d) in enumerate(sorted(versions))] + [(None, start, -1), (name(3), None, -2)]
    rows = [(i, None if i % 50 == 7 else name(0 if i % 3 == 0 else rnd.randint(1, 45)),
             None if i % 70 == 9 else dt.date(2026, 6, 1) if i % 6 == 0 else days()) for i in range(3000)]
    left = spark.createDataFrame(rows, f"i long, key {kind}, day date")
    right = spark.createDataFrame(versions, f"key {kind}, since date, n long")
    for extend in (False, True):
        want = brute(rows, versions, extend)
        got = as_of_join(left, right, "key", F.col("day"), "since", ["n"], extend, how="left", num_ranges=50)
        assert sorted((r["i"], r["n"]) for r in got.collect()) == want
        inner = as_of_join(left, right, "key", F.col("day"), "since", ["n"], extend, num_ranges=50)
        assert sorted((r["i"], r["n"]) for r in inner.collect()) == [w for w in want if w[1] is not None]


def test_as_of_on_empty_sides(spark):
    left = spark.createDataFrame([(1, 5, dt.date(2026, 1, 1))], "i long, key long, day date")
    right = spark.createDataFrame([], "key long, since date, n long")
    assert as_of_join(left, right, "key", F.col("day"), "since", ["n"]).count() == 0
    assert [tuple(r) for r in as_of_join(left, right, "key", F.col("day"), "since", ["n"], how="left").collect()] == [
        (1, 5, dt.date(2026, 1, 1), None)]
    assert as_of_join(left.limit(0), right, "key", F.col("day"), "since", ["n"], how="left").count() == 0


def test_as_of_is_linear_for_a_customer_with_ten_thousand_versions(spark):
    n = 60000
    first = F.lit("1990-01-01").cast("date")
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 2).alias("key"),
        F.date_add(first, (F.col("id") % 10000).cast("int")).alias("day"))
    versions = spark.range(10000).select(F.lit(1).cast("long").alias("key"), F.date_add(first, F.col("id").cast("int")).alias(
        "since"), F.col("id").alias("n")).unionByName(spark.range(2, 999).select(F.col("id").alias("key"), first.alias("since"),
                                                                                F.col("id").alias("n")))
    got = as_of_join(orders, versions, "key", F.col("day"), "since", ["n"], num_ranges=64)
    plan = plan_of(got)
    joins = [line for line in plan.splitlines() if "Join" in line and line.strip().startswith("(")]
    assert joins and all("BroadcastHashJoin" in j for j in joins)  # only the carry, never versions with orders
    assert "(_time" not in "".join(line for line in plan.splitlines() if "Join condition" in line)
    assert got.where(F.col("n") != F.when(F.col("key") == 1, F.col("order_id") % 10000).otherwise(F.col("key"))).count() == 0
    assert got.count() == n
    events = orders.select(F.xxhash64("key").alias("h"), "day", F.col("order_id").alias("tie"))
    events = materialize(events, "test")
    sizes = [r["count"] for r in ranged(events, ["h", "day", "tie"], 64).groupBy("_range").count().collect()]
    assert max(sizes) < 2.5 * n / 64  # the hot key's rows are spread over ranges


# --- bitmaps ------------------------------------------------------------------

def test_bitmap_checks_equal_grouping(spark):
    rnd = random.Random(2)
    keys = list(range(-40000, 90000)) + [0, 0, 32768, -32768, 89999, None, None]
    rnd.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").coalesce(1)
    assert bitmaps.dense([("t", df, "k")]) == {"t"}
    got = sorted(((r["k"], r["n_rows"]) for r in quality.key_uniqueness(df, ["k"]).collect()), key=repr)
    want = df.groupBy("k").count().where("count > 1").collect()
    assert got == sorted(((r["k"], r["count"]) for r in want), key=repr)
    parent = spark.range(-40000, 90000).where("id NOT IN (-40000, -32768, 0, 5, 89999)").coalesce(1)
    orphans = quality.ri_orphans(df, parent, "k", "id")
    assert sorted(r["k"] for r in orphans.collect()) == sorted([-40000, -32768, -32768, 0, 0, 0, 5, 89999, 89999])


def test_clean_tables_shuffle_bitmaps_only(spark):
    child = spark.range(200000).select((F.col("id") % 50000).alias("fk")).coalesce(2)
    parent = spark.range(60000).coalesce(1)
    orphans = quality.ri_orphans(child, parent, "fk", "id")
    repeated = quality.key_uniqueness(parent, ["id"])
    for df in (orphans, repeated):
        assert df.count() == 0 and "Range" not in plan_of(df)  # no row of the tables is read again


def test_scattered_and_other_keys_go_the_ordinary_way(spark):
    far = spark.range(3000).select((F.col("id") * 10**12).alias("k"))
    far = far.unionByName(far.limit(2))
    assert bitmaps.dense([("t", far, "k")]) == set()
    assert quality.key_uniqueness(far, ["k"]).count() == 2
    names = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "s string, i int")
    assert {r["s"] for r in quality.key_uniqueness(names, ["s"]).collect()} == {"a", None}
    assert quality.key_uniqueness(names, ["s", "i"]).count() == 2
    assert [r["s"] for r in quality.ri_orphans(names, names.where("s = 'a'"), "s").collect()] == ["b"]


def test_checks_on_empty_tables(spark):
    empty, some = spark.createDataFrame([], "k long"), spark.range(40000).withColumnRenamed("id", "k").coalesce(1)
    assert quality.key_uniqueness(empty, ["k"]).count() == 0
    assert quality.ri_orphans(empty, some, "k").count() == 0
    assert quality.ri_orphans(some, empty, "k").count() == 40000
    assert quality.ri_orphans(some.where("k < 0"), empty, "k").count() == 0
