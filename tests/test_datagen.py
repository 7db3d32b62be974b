from pyspark.sql import functions as F

from tidemart.operators import datagen
from tidemart.sources.testdata import table
from conftest import SF_SMALL


def test_generator_rates_and_shapes(spark):
    keys = spark.range(4000).withColumnRenamed("id", "k")
    c = datagen.seed_customers(keys, "k")
    assert c.count() == 4005 and c.select("customer_id").distinct().count() == 4005
    upper = c.filter(F.col("last_name") == F.upper("last_name")).count()
    nulls = c.filter(F.col("email").isNull()).count()
    assert 120 <= upper <= 300 and 20 <= nulls <= 110  # ~5 % dirty, ~30 % of those without email
    o = datagen.seed_orders(keys, "k", num_customers=500)
    items = datagen.seed_order_items(o, num_products=200)
    per = items.groupBy("order_id").count().agg(F.min("count"), F.max("count")).first()
    assert (per[0], per[1]) == (1, 4)
    assert items.filter(~F.col("discount_pct").isin(0, 5, 10, 15)).count() == 0
    assert o.filter((F.col("customer_id") < 1) | (F.col("customer_id") > 500)).count() == 0


def test_generator_is_deterministic(spark):
    keys = table(spark, SF_SMALL, "customer").select("c_custkey")
    a = datagen.seed_customers(keys, "c_custkey").collect()
    b = datagen.seed_customers(keys.repartition(5), "c_custkey").collect()
    key = lambda r: r["customer_id"]
    assert sorted(a, key=key) == sorted(b, key=key)


def test_customers_of_one_split_are_made_by_many_tasks(spark):
    made = datagen.seed_customers(spark.range(0, 4000, 1, 1).withColumnRenamed("id", "k"), "k", duplicates=0)
    assert made.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
