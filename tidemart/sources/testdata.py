"""Adapters from the shared test tables to the five source-table shapes.

The shared tables are TPC-H-like and clean, so the dirt the pipeline must
handle is injected by fixed modular rules on the keys. Every rule here has a
line-for-line SQL twin in ``tidemart.plans.oracle`` so DuckDB can recompute
each query from the same parquet files.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.config import CUSTOMER_SCD
from tidemart.operators.clean import clean_customers

# Adapter rule: market segment -> raw (dirty) loyalty tier text.
SEGMENT_TIER = {
    "BUILDING": "BRONZE",
    "AUTOMOBILE": " silver ",
    "MACHINERY": "Gold",
    "HOUSEHOLD": "PLATINUM",
}
WAREHOUSES = ("WH-EAST", "WH-WEST", "WH-CENTRAL")


_READERS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one shared table; the (immutable) DataFrame is reused per
    session, so its files are listed and its footer read only once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _READERS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


def _day_ts(start: str, days: Column) -> Column:
    """Midnight of ``start + days`` as timestamp_ntz."""
    return F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("timestamp_ntz")


def new_key(k: Column) -> Column:
    """A key that no source row has: source keys are not negative."""
    return -k - 1


def sku(k: Column) -> Column:
    """SKU of a product: at least six digits, more for longer keys."""
    text = k.cast("string")
    return F.concat(F.lit("SKU-"), F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text))


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers as extracted: dirty text, some later duplicates per id."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation x region is tiny; the planner's size check broadcasts it.
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    base = c.join(geo, c.c_nationkey == geo.n_nationkey, "left")
    k = F.col("c_custkey")

    # One pass: ids with id%10=0 also emit a later re-extraction (tier gold,
    # 30 days newer) -- an explode, not a second scan and join.
    rows = base.withColumn("_later", F.explode(
        F.when(k % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    later = F.col("_later")
    tier = F.when(later, F.lit("gold")).otherwise(_case(F.col("c_mktsegment"), SEGMENT_TIER, "NOT_A_REAL_TIER"))
    return rows.select(
        k.alias("customer_id"),
        F.when(k % 3 == 0, " jOHN ").when(k % 3 == 1, "MARY-jane").otherwise("ann  lee").alias("first_name"),
        F.when(k % 4 == 0, F.upper("n_name")).otherwise(F.lower("n_name")).alias("last_name"),
        F.when(k % 33 == 0, F.lit(None).cast("string"))
         .when(k % 20 == 0, F.lit("not-an-email"))
         .otherwise(F.concat(F.lit(" C"), k.cast("string"), F.lit("@Example.com"))).alias("email"),
        F.concat((k % 997).cast("string"), F.lit(" Main St")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("postal_code"),
        F.lit("USA").alias("country"),
        tier.alias("loyalty_tier"),
        F.lit("2025-06-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        _day_ts("2026-01-01", k % 90 + F.when(later, 30).otherwise(0)).alias("updated_at"),
    )


def _rotate_tier(c: Column) -> Column:
    return (F.when(c == "BRONZE", "SILVER").when(c == "SILVER", "GOLD")
             .when(c == "GOLD", "PLATINUM").otherwise("BRONZE"))


def customer_snapshot(spark: SparkSession, sf_dir: str, version: int = 1,
                      v1: DataFrame | None = None) -> DataFrame:
    """Silver customer snapshot (SCD source columns) for as-of version 1..3.

    v2: tier moves for id%7=0, first_name edits (untracked) for id%11=0,
        ids with id%13=0 are missing, ids with id%17=0 reappear under
        -id-1 as new customers.
    v3: as v2, plus another tier move for id%5=0; the id%13=0 rows return,
        those with id%26=0 with a changed city.
    ``v1`` lets callers pass an already written silver snapshot 1.
    """
    if v1 is None:
        v1 = clean_customers(customers_raw(spark, sf_dir)).select(*CUSTOMER_SCD.source_columns)
    if version == 1:
        return v1
    if version not in (2, 3):
        raise ValueError("version must be 1, 2 or 3")
    k = F.col("customer_id")
    # One pass: ids with id%17=0 are emitted twice, the copy as a new customer.
    rows = v1.withColumn("_copy", F.explode(
        F.when(k % 17 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    old = ~F.col("_copy")
    tier = F.col("loyalty_tier")
    tier2 = F.when(old & (k % 7 == 0), _rotate_tier(tier)).otherwise(tier)
    fname = F.when(old & (k % 11 == 0), F.concat(F.col("first_name"), F.lit("x"))).otherwise(F.col("first_name"))
    if version == 2:
        rows = rows.filter(~old | (k % 13 != 0)).withColumns({"loyalty_tier": tier2, "first_name": fname})
    else:
        tier3 = F.when(old & (k % 5 == 0), _rotate_tier(tier2)).otherwise(tier2)
        city = F.when(old & (k % 26 == 0), F.concat(F.col("city"), F.lit(" North"))).otherwise(F.col("city"))
        rows = rows.withColumns({"loyalty_tier": tier3, "first_name": fname, "city": city})
    rows = rows.withColumn("customer_id", F.when(old, k).otherwise(new_key(k)))
    return rows.select(*CUSTOMER_SCD.source_columns)


SNAPSHOT_DATES = {1: "2026-01-01", 2: "2026-03-01", 3: "2026-04-01"}


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as extracted: NULL customers, bad/NULL shipping, padded status,
    and a later duplicate (status shipped) for every ninth order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.date_add(F.lit("2025-12-01").cast("date"),
                     (F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 180).cast("int"))
    order_ts = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                    (k % 24).cast("int"), F.lit(0), F.lit(0))
    status = (F.when(k % 97 == 0, "cancelled").when(k % 89 == 0, "RETURNED ")
               .when(F.col("o_orderstatus") == "F", " delivered ")
               .when(F.col("o_orderstatus") == "O", "Placed").otherwise("shipped "))
    ship = (F.when(k % 40 == 0, F.lit(-1)).when(k % 41 == 0, F.lit(None))
             .otherwise(k % 25)).cast("decimal(10,2)")
    # One pass: every ninth order also emits a later version (status shipped).
    rows = o.withColumn("_later", F.explode(
        F.when(k % 9 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    later = F.col("_later")
    upd = order_ts + F.expr("INTERVAL 1 HOUR")
    return rows.select(
        k.alias("order_id"),
        F.when(k % 50 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("customer_id"),
        F.when(later, F.lit("shipped")).otherwise(status).alias("order_status"),
        order_ts.alias("order_date"),
        ship.alias("shipping_cost"),
        F.when(later, upd + F.expr("INTERVAL 5 DAYS")).otherwise(upd).alias("updated_at"),
    )


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items from lineitem; the id is the text of the line's key columns,
    so ids of any size stay distinct."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(5,2)").alias("discount_pct"),
    )


def products_raw(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """products from part; version 2 (parts with key%4 != 3 only) raises the
    price of every sixth part by 10 % and renames every eighth (untracked)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    if version == 2:
        p = p.filter(k % 4 != 3)
    price = F.col("p_retailprice").cast("decimal(10,2)")
    name = F.col("p_name")
    day = k % 60
    if version == 2:
        price = F.when(k % 6 == 0, F.round(price * F.lit(1.10).cast("decimal(3,2)"), 2)).otherwise(price) \
                 .cast("decimal(10,2)")
        name = F.when(k % 8 == 0, F.concat(name, F.lit(" v2"))).otherwise(name)
        day = day + 90
    return p.select(
        k.alias("product_id"),
        sku(k).alias("sku"),
        name.alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        F.lit("2025-06-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        _day_ts("2026-01-01", day).alias("updated_at"),
    )


def inventory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inventory row per part."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    wh = F.when(k % 3 == 0, WAREHOUSES[0]).when(k % 3 == 1, WAREHOUSES[1]).otherwise(WAREHOUSES[2])
    return p.select(
        k.alias("inventory_id"),
        k.alias("product_id"),
        wh.alias("warehouse_code"),
        (k * 7 % 501).cast("int").alias("quantity_on_hand"),
        (k % 46 + 5).cast("int").alias("reorder_level"),
        _day_ts("2026-01-01", k % 30).alias("updated_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def customer_deletes(spark: SparkSession, sf_dir: str, version: int = 2, v1: DataFrame | None = None) -> DataFrame:
    """A snapshot with an explicit delete flag: none in version 1, id%19=0 in
    version 2, id%23=0 in version 3 (the id%19=0 rows are back)."""
    src = customer_snapshot(spark, sf_dir, version, v1=v1)
    k = F.col("customer_id")
    return src.withColumn("is_deleted", {1: F.lit(False), 2: k % 19 == 0, 3: k % 23 == 0}[version])


def day_two_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five sources a day later: customers with id%7=0 moved to platinum,
    items of products with id%11=0 corrected to one more piece, products in
    version 2; everything else is pulled again unchanged."""
    raw = customers_raw(spark, sf_dir)
    moved = raw.filter(F.col("customer_id") % 7 == 0).withColumns({
        "loyalty_tier": F.lit("platinum"), "updated_at": F.lit("2026-06-01 00:00:00").cast("timestamp_ntz")})
    items = order_items_raw(spark, sf_dir)
    return {
        "customers": raw.unionByName(moved),
        "products": products_raw(spark, sf_dir, 2),
        "orders": orders_raw(spark, sf_dir),
        "order_items": items.withColumn("quantity", F.when(
            F.col("product_id") % 11 == 0, F.col("quantity") + 1).otherwise(F.col("quantity"))),
        "inventory": inventory_raw(spark, sf_dir),
    }


def customer_content_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers plus exact copies under new ids (id%250=7 -> -id-1),
    the way re-inserted duplicates receive fresh ids at the source."""
    raw = customers_raw(spark, sf_dir)
    copies = raw.filter(F.col("customer_id") % 250 == 7)
    return raw.unionByName(copies.withColumn("customer_id", new_key(F.col("customer_id"))))
