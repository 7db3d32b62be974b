"""Distributed, deterministic generator of dirty source rows.

Each generator takes a DataFrame of keys (derived from real tables, so the
output grows with them) and derives every attribute from a hash of the key
and a per-attribute salt: no driver loop, no random state, the same rows on
every run and every retry. The hash is the first 60 bits of ``md5`` (a
built-in of Spark and of most SQL engines, so generated data can be
re-derived in SQL); prices are drawn as integer cents, so they are exact.
Dirt is injected by rate, as in the original seeder: a share of customers
gets an upper-cased last name and (30 % of those) a missing email; a handful
of customers are re-inserted with new ids; orders get 1-4 items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.config import ORDER_STATUSES, VALID_TIERS

# Fixed values of the original seeder (value domains).
CATEGORIES = {
    "Electronics": ["Laptops", "Phones", "Accessories"],
    "Home": ["Kitchen", "Furniture", "Decor"],
    "Apparel": ["Men", "Women", "Kids"],
    "Sports": ["Fitness", "Outdoor", "Team Sports"],
}
DISCOUNTS = [0, 0, 0, 5, 10, 15]
WAREHOUSES = ["WH-EAST", "WH-WEST", "WH-CENTRAL"]

# Name parts for generated people and places (our own rule, not fixed values).
SYLLABLES = ["an", "bel", "cor", "da", "el", "fin", "gar", "ha", "is", "jo", "ka", "lin",
             "mar", "no", "or", "pe", "quin", "ros", "sa", "ten", "ul", "ver", "wil", "zo"]


def _h(key: Column, salt: str) -> Column:
    """Non-negative 60-bit hash of (key, salt)."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _pick(key: Column, salt: str, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_h(key, salt) % len(values) + 1).cast("int"))


def _int(key: Column, salt: str, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi]."""
    return (_h(key, salt) % (hi - lo + 1) + lo).cast("int")


def _chance(key: Column, salt: str, rate: float) -> Column:
    return _h(key, salt) % 10000 < int(round(rate * 10000))


def _money(key: Column, salt: str, lo: int, hi: int) -> Column:
    """Uniform price in [lo, hi] with cents, as decimal(10,2)."""
    cents = _h(key, salt) % ((hi - lo) * 100 + 1) + lo * 100
    return (cents.cast("decimal(10,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)")


def _word(key: Column, salt: str, parts: int = 2) -> Column:
    return F.initcap(F.concat(*[_pick(key, f"{salt}{i}", SYLLABLES) for i in range(parts)]))


def sample_n(df: DataFrame, n: int, key: str, seed: str = "sample") -> DataFrame:
    """Deterministic pseudo-random ``n`` rows (distributed top-n by hash)."""
    return df.orderBy(_h(F.col(key), seed), F.col(key)).limit(n)


def seed_customers(keys: DataFrame, key: str, dirty_rate: float = 0.05,
                   duplicates: int = 5, start_id: int = 1) -> DataFrame:
    """Customers for each key; ``duplicates`` of them re-inserted under new ids."""
    base = _customers(spread_keys(keys, key), key, dirty_rate, start_id)
    if duplicates <= 0:
        return base
    # Re-inserted copies get fresh ids above every existing one (one scalar
    # to the driver; the window below numbers only the sampled rows). The
    # sample is drawn from the ids; attributes are worked out for those it keeps.
    ids = keys.select(F.col(key), _customer_id(key, start_id))
    top = ids.agg(F.max("customer_id")).first()[0] or 0
    drawn = sample_n(ids, duplicates, "customer_id", "dupe").select(key)
    dup = _customers(drawn, key, dirty_rate, start_id).withColumn(
        "customer_id", (F.lit(top) + F.row_number().over(Window.orderBy("customer_id"))).cast("bigint"))
    return base.unionByName(dup)


def spread_keys(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` dealt evenly to tasks: every row costs some twenty digests, and a key column may lie in a single split."""
    return keys.select(key).repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _customer_id(key: str, start_id: int) -> Column:
    return (F.col(key) + start_id).cast("bigint").alias("customer_id")


def _customers(keys: DataFrame, key: str, dirty_rate: float, start_id: int) -> DataFrame:
    k = F.col(key)
    dirty = _chance(k, "dirty", dirty_rate)
    last = _word(k, "last", 3)
    return keys.select(
        _customer_id(key, start_id),
        _word(k, "first").alias("first_name"),
        F.when(dirty, F.upper(last)).otherwise(last).alias("last_name"),
        F.when(dirty & _chance(k, "nomail", 0.3), F.lit(None).cast("string"))
         .otherwise(F.lower(F.concat(_word(k, "mail"), F.lit("."), (k % 1000).cast("string"),
                                     F.lit("@example.com")))).alias("email"),
        F.concat(_int(k, "street", 1, 9999).cast("string"), F.lit(" "), _word(k, "road"),
                 F.lit(" St")).alias("address"),
        _word(k, "city", 3).alias("city"),
        F.upper(F.substring(_word(k, "state"), 1, 2)).alias("state"),
        F.lpad(_int(k, "zip", 0, 99999).cast("string"), 5, "0").alias("postal_code"),
        F.lit("USA").alias("country"),
        _pick(k, "tier", list(VALID_TIERS)).alias("loyalty_tier"),
    )


def seed_products(keys: DataFrame, key: str, start_id: int = 1) -> DataFrame:
    k = F.col(key)
    cat = _pick(k, "cat", list(CATEGORIES))
    subs = F.element_at(F.create_map(*[x for c, ss in CATEGORIES.items()
                                       for x in (F.lit(c), F.array(*[F.lit(s) for s in ss]))]), cat)
    return keys.select(
        (k + start_id).cast("bigint").alias("product_id"),
        F.concat(F.lit("SKU-"), F.when(k + start_id < 10_000, F.lpad((k + start_id).cast("string"), 5, "0"))
                 .otherwise((k + start_id).cast("string"))).alias("sku"),
        F.concat(_word(k, "adj"), F.lit(" "), _word(k, "noun", 3)).alias("product_name"),
        cat.alias("category"),
        F.element_at(subs, (_h(k, "sub") % 3 + 1).cast("int")).alias("subcategory"),
        _money(k, "price", 5, 800).alias("unit_price"),
    )


def seed_orders(keys: DataFrame, key: str, num_customers: int, anchor: str = "2026-06-30",
                start_id: int = 1) -> DataFrame:
    """Orders over the 180 days before ``anchor``."""
    k = F.col(key)
    day = F.date_sub(F.lit(anchor).cast("date"), _int(k, "day", 0, 179))
    ts = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                              _int(k, "hh", 0, 23), _int(k, "mi", 0, 59), F.lit(0))
    return keys.select(
        (k + start_id).cast("bigint").alias("order_id"),
        (_h(k, "cust") % num_customers + 1).cast("bigint").alias("customer_id"),
        _pick(k, "status", list(ORDER_STATUSES)).alias("order_status"),
        ts.alias("order_date"),
        _money(k, "ship", 0, 25).alias("shipping_cost"),
    )


def seed_order_items(orders: DataFrame, num_products: int) -> DataFrame:
    """1-4 items per order, exploded per order (no shuffle)."""
    o = F.col("order_id")
    lines = orders.select("order_id", F.explode(F.sequence(F.lit(1), _int(o, "nitems", 1, 4))).alias("line"))
    lk = F.col("order_id") * 8 + F.col("line")
    return lines.select(
        lk.cast("bigint").alias("order_item_id"),
        "order_id",
        (_h(lk, "prod") % num_products + 1).cast("bigint").alias("product_id"),
        _int(lk, "qty", 1, 5).alias("quantity"),
        _money(lk, "price", 5, 800).alias("unit_price"),
        _pick(lk, "disc", DISCOUNTS).cast("decimal(5,2)").alias("discount_pct"),
    )


def seed_inventory(products: DataFrame) -> DataFrame:
    p = F.col("product_id")
    return products.select(
        p.alias("inventory_id"), p.alias("product_id"),
        _pick(p, "wh", WAREHOUSES).alias("warehouse_code"),
        _int(p, "onhand", 0, 500).alias("quantity_on_hand"),
        _int(p, "reorder", 5, 50).alias("reorder_level"),
    )
