"""A key holding a third of all rows must be split, not funnelled into one task."""

import contextlib
import io
from datetime import date

from pyspark.sql import functions as F

from tidemart.operators.clean import dedup_latest
from tidemart.operators.marts import build_fact_sales


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_fact_join_splits_hot_customer(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        orders = spark.range(n).select(
            F.col("id").alias("order_id"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2).cast("bigint").alias("customer_id"),
            F.lit("PLACED").alias("order_status"),
            F.lit("2026-02-01 00:00:00").cast("timestamp_ntz").alias("order_date"))
        items = orders.select("order_id", (F.col("order_id") * 10).alias("order_item_id"),
                              F.lit(1).cast("bigint").alias("product_id"), F.lit(1).alias("quantity"),
                              F.lit(1.0).alias("unit_price"), F.lit(0.0).alias("discount_pct"),
                              F.lit(1.0).alias("line_total"))
        dim = spark.range(1, 1000).select(
            F.col("id").alias("customer_id"), F.col("id").alias("customer_sk"), F.lit("GOLD").alias("loyalty_tier"),
            F.lit(date(2026, 1, 1)).alias("effective_start_date"),
            F.lit(date(9999, 12, 31)).alias("effective_end_date"), F.lit(True).alias("is_current"))
        fact = build_fact_sales(items, orders, dim)
        plan = _final_plan(fact)
        assert fact.count() == n
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_dedup_cuts_hot_key_before_shuffle(spark):
    df = spark.range(50000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("v"))
    out = dedup_latest(df.repartition(8), ["k"], ["v"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    # partial group limit below the exchange, final one above it
    assert plan.count("WindowGroupLimit") == 2
    # the plan prints top-down: the partial limit is printed below the exchange
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning(k")
    assert out.filter("k = 0").first()["v"] == 49998
