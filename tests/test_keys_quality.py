import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators.keys import dense_keys, with_neighbors
from tidemart.operators.quality import (
    apply_defaults,
    apply_expectations,
    content_duplicate_map,
    content_duplicates,
    expectation_summary,
    key_uniqueness,
    ri_orphans,
)


def test_dense_keys_equal_global_row_number(spark):
    rnd = random.Random(7)
    keys = [rnd.randint(0, 10**9) for _ in range(3000)] + list(range(500))  # clustered tail
    df = spark.createDataFrame([(k,) for k in set(keys)], "k long")
    got = dense_keys(df, ["k"], "sk", base=100, num_buckets=7)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("k")) + 100)
    bad = got.join(ref, "k").filter(F.col("sk") != F.col("ref")).count()
    assert bad == 0 and got.count() == df.count()


def test_dense_keys_on_empty_input(spark):
    df = spark.createDataFrame([], "k long")
    assert dense_keys(df, ["k"], "sk").count() == 0


def test_expectations_null_counts_as_failure(spark):
    df = spark.createDataFrame([(1, 5.0), (None, 1.0), (3, None)], "c long, s double")
    rules = {"c_present": "c IS NOT NULL", "s_ok": "s >= 0"}
    rows = {r["c"]: (r["_dq_valid"], r["_dq_failed_rules"]) for r in apply_expectations(df, rules).collect()}
    assert rows[1] == (True, []) and rows[None] == (False, ["c_present"]) and rows[3] == (False, ["s_ok"])
    summ = {r["rule"]: (r["rows_checked"], r["rows_failed"]) for r in expectation_summary(df, rules).collect()}
    assert summ == {"c_present": (3, 1), "s_ok": (3, 1)}


def test_ri_orphans_and_uniqueness(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, fk long")
    parent = spark.createDataFrame([(10,), (10,)], "pk long")
    assert [r["id"] for r in ri_orphans(child, parent, "fk", "pk").collect()] == [2]
    assert [(r["pk"], r["n_rows"]) for r in key_uniqueness(parent, ["pk"]).collect()] == [(10, 2)]


def test_content_duplicates_ignore_case_and_spaces(spark):
    df = spark.createDataFrame([(1, "Ann ", "x@y.com"), (2, "ann", "X@Y.COM"), (3, "Bo", "b@y.com")],
                               "id long, name string, email string")
    out = content_duplicates(df, "id", ["name", "email"]).collect()
    assert len(out) == 1 and out[0]["keep_id"] == 1 and out[0]["n_ids"] == 2


def test_neighbors_match_lag_lead_with_a_hot_key(spark):
    rows = [(0, t, t * 3 % 7) for t in range(400)] + [(k, t, k + t) for k in range(1, 40) for t in range(3)]
    df = spark.createDataFrame(rows, "k long, t long, v long")
    got = with_neighbors(df, "k", ["t"], prev_cols=["v"], next_cols=["t"], num_buckets=6)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("rv"), F.lead("t").over(w).alias("rt"))
    bad = (got.join(ref, ["k", "t"])
              .filter(~F.col("_prev_v").eqNullSafe(F.col("rv")) | ~F.col("_next_t").eqNullSafe(F.col("rt"))))
    assert bad.count() == 0 and got.count() == len(rows)


def test_defaults_fill_nulls_only(spark):
    df = spark.createDataFrame([(1, None, None), (2, "SHIPPED", 5.0)], "id long, order_status string, d double")
    out = {r["id"]: (r["order_status"], r["d"])
           for r in apply_defaults(df, {"order_status": "PLACED", "d": 0, "absent": 1}).collect()}
    assert out == {1: ("PLACED", 0.0), 2: ("SHIPPED", 5.0)}


def test_content_duplicate_map_with_null_attributes(spark):
    df = spark.createDataFrame([(1, "Ann", None), (7, "ann ", None), (3, "Bo", "x"), (9, "bo", "x")],
                               "id long, name string, email string")
    got = sorted(tuple(r) for r in content_duplicate_map(df, "id", ["name", "email"]).collect())
    assert got == [(7, 1), (9, 3)]


def test_dense_keys_on_large_shuffled_input(spark):
    # more rows than the range sampler keeps, arriving from a hash shuffle
    df = (spark.range(60000).select((F.col("id") * 7919 % 1000003).alias("k"))
               .repartition(5, "k").filter(F.col("k") % 3 != 0))
    got = dense_keys(df, ["k"], "sk", num_buckets=6)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("k")))
    assert got.join(ref, "k").filter(F.col("sk") != F.col("ref")).count() == 0


def test_unique_keys_fill_no_map_and_a_hot_key_is_added_up_first(spark):
    many = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"))
    twice = many.unionByName(many.limit(3))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = key_uniqueness(twice, ["k"])
    assert "partial_count" not in plan(found)  # an exchange of keys, no map of them in a split
    assert found.count() == 3 and {r["n_rows"] for r in found.collect()} == {2}
    hot = many.unionByName(spark.range(30000).select(F.lit("hot").alias("k"))).unionByName(spark.range(9000).select(F.lit(None).cast("string").alias("k")))
    found = key_uniqueness(hot, ["k"])
    assert plan(found).count("partial_count") == 1
    assert {(r["k"], r["n_rows"]) for r in found.collect()} == {("hot", 30000), (None, 9000)}
