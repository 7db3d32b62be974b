"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the shared test tables (through the adapters) in full,
so its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.config import CUSTOMER_SCD, PRODUCT_SCD, TableSpec
from tidemart.operators import clean, datagen, quality, scd
from tidemart.operators.marts import attach_product, build_fact_sales, revenue_by_tier, revenue_by_tier_sql
from tidemart.plans import daily
from tidemart.session import materialize, remember, scratch_dir, scratch_name
from tidemart.sources import extract, lake
from tidemart.sources import testdata as td
from tidemart.streaming import ingest as stream

Query = Callable[[SparkSession, str], DataFrame]


def _d(s: str) -> date:
    return date.fromisoformat(s)


# --- silver -----------------------------------------------------------------

def q_clean_customers(spark, sf):
    return clean.clean_customers(td.customers_raw(spark, sf))


def q_clean_orders(spark, sf):
    return clean.clean_orders(td.orders_raw(spark, sf))


def _orders_split(spark, sf):
    return quality.quarantine_invalid(q_clean_orders(spark, sf))


def q_orders_valid(spark, sf):
    return _orders_split(spark, sf)[0]


def q_orders_quarantine(spark, sf):
    return _orders_split(spark, sf)[1]


def q_orders_undetermined(spark, sf):
    return quality.undetermined(q_clean_orders(spark, sf))


def q_line_total(spark, sf):
    return clean.calculate_line_total(td.order_items_raw(spark, sf))


# --- gold: customer dimension -------------------------------------------------

def q_row_hash(spark, sf):
    src = td.customer_snapshot(spark, sf, 1)
    return scd.add_row_hash(src, scd.CUSTOMER_SCD.tracked).select("customer_id", "row_hash")


def silver_customers(spark, sf) -> DataFrame:
    """Silver snapshot 1, written once like the silver table it stands for."""
    return materialize(td.customer_snapshot(spark, sf, 1), "silver-customers")


def snapshot(spark, sf, v: int, v1: DataFrame) -> DataFrame:
    return v1 if v == 1 else td.customer_snapshot(spark, sf, v, v1=v1)


def dim_after(spark, sf, version: int, v1: DataFrame | None = None) -> DataFrame:
    """Customer dimension after applying snapshots 1..version in order."""
    v1 = v1 if v1 is not None else silver_customers(spark, sf)
    dim = None
    for v in range(1, version + 1):
        src = snapshot(spark, sf, v, v1)
        # Each result already reads from files written inside the merge
        # (classified rows, keyed buckets), so no extra write between steps.
        dim = scd.compute_scd2_snapshot(dim, src, _d(td.SNAPSHOT_DATES[v]))
    return dim


def q_scd2_initialize(spark, sf):
    return scd.initialize_dimension(td.customer_snapshot(spark, sf, 1),
                                    as_of_date=_d(td.SNAPSHOT_DATES[1]))


def q_scd2_merge_v2(spark, sf):
    return dim_after(spark, sf, 2)


def q_scd2_merge_v3(spark, sf):
    return dim_after(spark, sf, 3)


# --- gold: facts and marts --------------------------------------------------

def fact_sales(spark, sf, mode: str = "current") -> DataFrame:
    items = q_line_total(spark, sf)
    orders = q_orders_valid(spark, sf)
    return build_fact_sales(items, orders, dim_after(spark, sf, 3), mode=mode)


def q_fact_sales_current(spark, sf):
    return fact_sales(spark, sf, "current")


def q_revenue_by_tier(spark, sf):
    return revenue_by_tier(fact_sales(spark, sf, "current"))


QUERIES: dict[str, Query] = {
    "clean_customers": q_clean_customers,
    "clean_orders": q_clean_orders,
    "orders_valid": q_orders_valid,
    "orders_quarantine": q_orders_quarantine,
    "orders_undetermined": q_orders_undetermined,
    "line_total": q_line_total,
    "row_hash": q_row_hash,
    "scd2_initialize": q_scd2_initialize,
    "scd2_merge_v2": q_scd2_merge_v2,
    "scd2_merge_v3": q_scd2_merge_v3,
    "fact_sales_current": q_fact_sales_current,
    "revenue_by_tier": q_revenue_by_tier,
}


# --- gold: SCD variants ---------------------------------------------------------

def _snapshots_with_dates(spark, sf) -> DataFrame:
    out = None
    v1 = silver_customers(spark, sf)
    for v, d in td.SNAPSHOT_DATES.items():
        s = snapshot(spark, sf, v, v1).withColumn("snapshot_date", F.lit(d).cast("date"))
        out = s if out is None else out.unionByName(s)
    return out


def q_scd2_backfill(spark, sf):
    return scd.scd2_backfill(_snapshots_with_dates(spark, sf), "snapshot_date")


def q_scd2_changes(spark, sf):
    v1 = silver_customers(spark, sf)
    dim2 = materialize(dim_after(spark, sf, 2, v1), "dim-customer-v2")
    return scd.scd2_changes(dim2, snapshot(spark, sf, 3, v1), _d(td.SNAPSHOT_DATES[3]))


def q_scd2_deletes(spark, sf):
    spec = replace(CUSTOMER_SCD, deleted_col="is_deleted")
    dim1 = materialize(dim_after(spark, sf, 1), "dim-customer-v1")
    return scd.compute_scd2_snapshot(dim1, td.customer_deletes(spark, sf), _d(td.SNAPSHOT_DATES[2]), spec=spec)


def q_scd2_backfill_deletes(spark, sf):
    spec = replace(CUSTOMER_SCD, deleted_col="is_deleted")
    v1 = silver_customers(spark, sf)
    out = None
    for v, d in td.SNAPSHOT_DATES.items():
        s = td.customer_deletes(spark, sf, v, v1).withColumn("snapshot_date", F.lit(d).cast("date"))
        out = s if out is None else out.unionByName(s)
    return scd.scd2_backfill(out, "snapshot_date", spec)


def q_scd2_changes_refresh(spark, sf):
    spec = replace(CUSTOMER_SCD, passthrough_mode="refresh")
    v1 = silver_customers(spark, sf)
    dim1 = materialize(dim_after(spark, sf, 1, v1), "dim-customer-v1")
    return scd.scd2_changes(dim1, snapshot(spark, sf, 2, v1), _d(td.SNAPSHOT_DATES[2]), spec)


def q_scd2_refresh_passthrough(spark, sf):
    spec = replace(CUSTOMER_SCD, passthrough_mode="refresh")
    v1 = silver_customers(spark, sf)
    dim1 = materialize(dim_after(spark, sf, 1, v1), "dim-customer-v1")
    return scd.compute_scd2_snapshot(dim1, snapshot(spark, sf, 2, v1), _d(td.SNAPSHOT_DATES[2]),
                                     spec=spec)


# --- gold: product dimension ----------------------------------------------------

PRODUCT_DATES = ("2026-01-01", "2026-04-01")


def q_dim_product_type1(spark, sf):
    both = td.products_raw(spark, sf, 1).unionByName(td.products_raw(spark, sf, 2))
    return scd.scd1_latest(both, ["product_id"], ["updated_at"])


def q_dim_product_scd2(spark, sf):
    cols = PRODUCT_SCD.source_columns
    dim1 = materialize(scd.initialize_dimension(td.products_raw(spark, sf, 1).select(*cols),
                                                as_of_date=_d(PRODUCT_DATES[0]), spec=PRODUCT_SCD),
                       "dim-product-v1")
    return scd.compute_scd2_snapshot(dim1, td.products_raw(spark, sf, 2).select(*cols),
                                     _d(PRODUCT_DATES[1]), spec=PRODUCT_SCD)


# --- gold: facts ----------------------------------------------------------------

def q_fact_sales_as_of(spark, sf):
    return fact_sales(spark, sf, "as_of")


def q_fact_sales_product(spark, sf):
    return attach_product(fact_sales(spark, sf, "current"), q_dim_product_type1(spark, sf))


def q_revenue_by_tier_as_of(spark, sf):
    view = scratch_name(spark, "views", "fact_sales_as_of")
    fact_sales(spark, sf, "as_of").createOrReplaceTempView(view)
    return revenue_by_tier_sql(spark, view)


# --- quality ---------------------------------------------------------------------

ORDER_RULES = {
    "customer_present": "customer_id IS NOT NULL",
    "shipping_non_negative": "shipping_cost >= 0",
    "status_in_domain": "upper(trim(order_status)) IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')",
    "order_date_present": "order_date IS NOT NULL",
}


def q_ri_orphans(spark, sf):
    """Foreign keys without parent, per check and key, with row counts.

    Parents are missing by rule: products with id%29=0, customers with id%31=0.
    """
    items = td.order_items_raw(spark, sf)
    products = td.products_raw(spark, sf, 1).filter(F.col("product_id") % 29 != 0)
    customers = td.customers_raw(spark, sf).filter(F.col("customer_id") % 31 != 0)
    checks = [
        ("order_items.order_id->orders_valid", items, "order_id", q_orders_valid(spark, sf), "order_id"),
        ("order_items.product_id->products", items, "product_id", products, "product_id"),
        ("orders.customer_id->customers", td.orders_raw(spark, sf), "customer_id", customers, "customer_id"),
        ("inventory.product_id->products", td.inventory_raw(spark, sf), "product_id", products, "product_id"),
    ]
    out = None
    orphans = quality.ri_orphans_all(checks)
    for name, _, ck, _, _ in checks:
        o = (orphans[name]
             .groupBy(F.col(ck).cast("bigint").alias("key_value"))
             .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
             .select(F.lit(name).alias("check_name"), "key_value", "n_rows"))
        out = o if out is None else out.unionByName(o)
    return out


def q_key_uniqueness(spark, sf):
    """Keys that occur twice: the raw re-extractions, and products over both versions by id and SKU."""
    products = td.products_raw(spark, sf, 1).unionByName(td.products_raw(spark, sf, 2))
    checks = [
        ("customers", td.customers_raw(spark, sf), "customer_id"),
        ("orders", td.orders_raw(spark, sf), "order_id"),
        ("order_items", td.order_items_raw(spark, sf), "order_item_id"),
        ("products", td.products_raw(spark, sf, 1), "product_id"),
        ("products.sku", td.products_raw(spark, sf, 1), "sku"),
        ("products.sku of both versions", products, "sku"),
        ("inventory", td.inventory_raw(spark, sf), "inventory_id"),
    ]
    out = None
    repeated = quality.key_uniqueness_all([(name, df, [k]) for name, df, k in checks])
    for name, _, k in checks:
        o = repeated[name].select(
            F.lit(name).alias("table_name"), F.col(k).cast("string").alias("key_value"), "n_rows")
        out = o if out is None else out.unionByName(o)
    return out


def q_not_null_summary(spark, sf):
    """NOT NULL columns of all five source tables: rows checked and rows missing a value."""
    out = None
    for name, df in adapter_sources(spark, sf).items():
        o = quality.expectation_summary(df, quality.not_null_rules(name))
        out = o if out is None else out.unionByName(o)
    return out


def q_expectations_summary(spark, sf):
    return quality.expectation_summary(td.orders_raw(spark, sf), ORDER_RULES)


def q_orders_failed_rules(spark, sf):
    checked = quality.apply_expectations(td.orders_raw(spark, sf), ORDER_RULES)
    return checked.select("order_id", "updated_at", "_dq_valid",
                          F.array_join("_dq_failed_rules", ",").alias("failed_rules"))


CONTENT_ATTRS = ["first_name", "last_name", "email", "address", "city", "state", "postal_code", "loyalty_tier"]


def q_content_duplicates(spark, sf):
    return quality.content_duplicates(td.customer_content_copies(spark, sf), "customer_id", CONTENT_ATTRS)


def q_content_duplicate_map(spark, sf):
    return quality.content_duplicate_map(td.customer_content_copies(spark, sf), "customer_id", CONTENT_ATTRS)


QUERIES.update({
    "scd2_backfill": q_scd2_backfill,
    "scd2_changes": q_scd2_changes,
    "scd2_deletes": q_scd2_deletes,
    "scd2_backfill_deletes": q_scd2_backfill_deletes,
    "scd2_changes_refresh": q_scd2_changes_refresh,
    "scd2_refresh_passthrough": q_scd2_refresh_passthrough,
    "dim_product_type1": q_dim_product_type1,
    "dim_product_scd2": q_dim_product_scd2,
    "fact_sales_as_of": q_fact_sales_as_of,
    "fact_sales_product": q_fact_sales_product,
    "revenue_by_tier_as_of": q_revenue_by_tier_as_of,
    "ri_orphans": q_ri_orphans,
    "key_uniqueness": q_key_uniqueness,
    "expectations_summary": q_expectations_summary,
    "orders_failed_rules": q_orders_failed_rules,
    "not_null_summary": q_not_null_summary,
    "content_duplicates": q_content_duplicates,
    "content_duplicate_map": q_content_duplicate_map,
})


# --- ingest: extract, raw, bronze, snapshots -----------------------------------

EVENTS_CUTOFF = "2024-01-15 00:00:00"


def _root(spark, label):
    return scratch_dir(spark, label)


def _data_cols(df: DataFrame) -> DataFrame:
    return clean.drop_metadata(df).drop("dt", "batch")


def q_full_extract(spark, sf):
    root = _root(spark, "full-extract")
    spec = TableSpec("products", "full")
    extract.extract_table(td.products_raw(spark, sf, 1), spec, root, "2026-01-01")
    return _data_cols(lake.read_raw(spark, root, "products", "2026-01-01"))


def _two_event_runs(spark, sf) -> str:
    """Run 1 sees the source as of the cutoff, run 2 the whole table."""
    root = _root(spark, "incremental")
    spec = TableSpec("events", "incremental", "ts", ("event_id",))
    ev = td.events(spark, sf)
    extract.extract_table(ev.filter(F.col("ts") <= F.lit(EVENTS_CUTOFF).cast("timestamp_ntz")),
                          spec, root, "2024-01-15", "run1")
    extract.extract_table(ev, spec, root, "2024-01-31", "run2")
    return root


def q_incremental_extract(spark, sf):
    root = _two_event_runs(spark, sf)
    return _data_cols(lake.read_raw(spark, root, "events", "2024-01-31"))


def q_watermark_max(spark, sf):
    root = _two_event_runs(spark, sf)
    return extract.read_watermarks(spark, root).select("table_name", "watermark_ts", "rows_extracted")


def q_extract_run_audit(spark, sf):
    root = _two_event_runs(spark, sf)
    return (spark.read.parquet(f"{root}/_control/run_audit")
                 .select("table_name", "mode", "rows_extracted", "run_id", "run_date"))


def q_raw_roundtrip(spark, sf):
    root = _root(spark, "raw-roundtrip")
    extract.extract_table(td.orders_raw(spark, sf), TableSpec("orders", "full"), root, "2026-03-01")
    lake.load_raw_to_bronze(spark, root, "orders", "2026-03-01")
    lake.load_raw_to_bronze(spark, root, "orders", "2026-03-01")  # re-run: replaces, no double rows
    return _data_cols(lake.read_bronze(spark, root, "orders"))


def q_bronze_append_merge_schema(spark, sf):
    root = _root(spark, "bronze-merge")
    spec = TableSpec("customers", "full")
    raw = td.customers_raw(spark, sf)
    extract.extract_table(raw, spec, root, "2026-01-01")
    lake.load_raw_to_bronze(spark, root, "customers", "2026-01-01")
    extract.extract_table(raw.withColumn("segment", F.upper(F.trim("loyalty_tier"))), spec, root, "2026-01-02")
    lake.load_raw_to_bronze(spark, root, "customers", "2026-01-02")
    b = lake.read_bronze(spark, root, "customers").withColumn("load_date", F.col(lake.LOAD_DATE))
    return _data_cols(b)


def q_silver_passthrough(spark, sf):
    root = _root(spark, "silver-pass")
    spec = TableSpec("products", "full")
    for v, day in ((1, "2026-01-01"), (2, "2026-04-01")):
        extract.extract_table(td.products_raw(spark, sf, v), spec, root, day)
        lake.load_raw_to_bronze(spark, root, "products", day)
    return daily.silver_latest(spark, root, "products")


def q_snapshot_overwrite(spark, sf):
    root = _root(spark, "snapshots")
    name = scratch_name(spark, "databases", "gold") + ".dim_customer"
    v1 = silver_customers(spark, sf)
    for v in (1, 2):
        existing = lake.read_table(spark, name)
        src = snapshot(spark, sf, v, v1)
        dim = scd.compute_scd2_snapshot(existing, src, _d(td.SNAPSHOT_DATES[v]))
        lake.publish_snapshot(dim, root, "dim_customer", name, f"v{v}")
    return spark.table(name)


def q_dim_maxima(spark, sf):
    """Largest key and latest start of the published dimension, from its files' footers."""
    root = _root(spark, "dim-maxima")
    name = scratch_name(spark, "databases", "gold") + ".dim_customer"
    path = lake.publish_snapshot(dim_after(spark, sf, 2), root, "dim_customer", name)
    return scd.dim_maxima(lake.from_footers(spark, path), CUSTOMER_SCD)


def adapter_sources(spark, sf) -> dict[str, DataFrame]:
    return {
        "customers": td.customers_raw(spark, sf),
        "products": td.products_raw(spark, sf, 1),
        "orders": td.orders_raw(spark, sf),
        "order_items": td.order_items_raw(spark, sf),
        "inventory": td.inventory_raw(spark, sf),
    }


def q_daily_batch_revenue(spark, sf):
    root = _root(spark, "daily")
    return daily.run_daily(spark, adapter_sources(spark, sf), root, "2026-01-01", _catalog(spark))


def _catalog(spark) -> daily.Catalog:
    prefix = scratch_name(spark, "databases", "silver").removesuffix("_silver")
    remember(spark, "databases", f"{prefix}_gold")
    return daily.Catalog(prefix=prefix)


def q_daily_two_days_revenue(spark, sf):
    """Two days, the second one run twice: the report after the repeated day."""
    root, cat = _root(spark, "two-days"), _catalog(spark)
    daily.run_daily(spark, adapter_sources(spark, sf), root, "2026-05-01", cat)
    later = td.day_two_sources(spark, sf)
    daily.run_daily(spark, later, root, "2026-06-02", cat)
    return daily.run_daily(spark, later, root, "2026-06-02", cat)


def q_quality_audit(spark, sf):
    """Rule counts that two days' silver writes observed, each over the rows that the day brings."""
    root, cat = _root(spark, "audit"), _catalog(spark)
    for day, sources in (("2026-05-01", adapter_sources(spark, sf)), ("2026-06-02", td.day_two_sources(spark, sf))):
        daily.run_extract(sources, root, day)
        daily.run_bronze(spark, root, day)
        daily.run_silver(spark, root, cat, day)
    return spark.read.schema(quality.AUDIT_SCHEMA).parquet(f"{root}/_control/quality_audit")


def q_bronze_widened_type(spark, sf):
    """Bronze over two days; on the second day quantity is a long and unit_price has more digits."""
    root = _root(spark, "bronze-widen")
    spec = TableSpec("order_items", "full")
    items = td.order_items_raw(spark, sf).select(
        "order_item_id", F.col("quantity").cast("int").alias("quantity"), F.col("unit_price").cast("decimal(10,2)").alias("unit_price"))
    wide = items.select("order_item_id", (F.col("quantity").cast("bigint") + 3000000000).alias("quantity"),
                        (F.col("unit_price") + F.lit("0.125").cast("decimal(3,3)")).cast("decimal(14,4)").alias("unit_price"))
    for day, rows in (("2026-01-01", items), ("2026-01-02", wide)):
        extract.extract_table(rows, spec, root, day)
        lake.load_raw_to_bronze(spark, root, "order_items", day)
    b = lake.read_bronze(spark, root, "order_items").withColumn("load_date", F.col(lake.LOAD_DATE))
    return _data_cols(b)


def q_publish_evolves(spark, sf):
    """Two publishes under different partition counts, the second with a new column."""
    root = _root(spark, "publish")
    name = scratch_name(spark, "databases", "gold") + ".customers"
    v1 = silver_customers(spark, sf)
    key, old = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, df in (("4", v1), ("16", snapshot(spark, sf, 2, v1).withColumn("segment", F.lower("loyalty_tier")))):
            spark.conf.set(key, parts)
            lake.publish_snapshot(df.repartition("customer_id"), root, "customers", name)
    finally:
        spark.conf.set(key, old)
    return spark.table(name)


def q_incremental_extract_by_id(spark, sf):
    """Incremental runs over an integer watermark; the second sees the newer half."""
    root = _root(spark, "incremental-id")
    spec = TableSpec("events", "incremental", "event_id", ("event_id",))
    ev = td.events(spark, sf)
    half = ev.agg(F.max("event_id").alias("m")).first()["m"] // 2
    extract.extract_table(ev.filter(F.col("event_id") <= half), spec, root, "2024-01-15", "run1")
    extract.extract_table(ev, spec, root, "2024-01-31", "run2")
    return _data_cols(lake.read_raw(spark, root, "events", "2024-01-31"))


QUERIES.update({
    "full_extract": q_full_extract,
    "incremental_extract": q_incremental_extract,
    "watermark_max": q_watermark_max,
    "extract_run_audit": q_extract_run_audit,
    "raw_roundtrip": q_raw_roundtrip,
    "bronze_append_merge_schema": q_bronze_append_merge_schema,
    "silver_passthrough": q_silver_passthrough,
    "snapshot_overwrite": q_snapshot_overwrite,
    "dim_maxima": q_dim_maxima,
    "daily_batch_revenue": q_daily_batch_revenue,
    "daily_two_days_revenue": q_daily_two_days_revenue,
    "quality_audit": q_quality_audit,
    "bronze_widened_type": q_bronze_widened_type,
    "publish_evolves": q_publish_evolves,
    "incremental_extract_by_id": q_incremental_extract_by_id,
})


# --- streaming ----------------------------------------------------------------------

def _land(df: DataFrame, landing: str, batch: int) -> None:
    df.write.mode("errorifexists").parquet(f"{landing}/batch-{batch:03d}")


def _event_batches(spark, sf):
    ev = td.events(spark, sf)
    cut = F.lit(EVENTS_CUTOFF).cast("timestamp_ntz")
    return ev, ev.filter(F.col("ts") <= cut), ev.filter(F.col("ts") > cut)


def q_stream_bronze(spark, sf):
    root = _root(spark, "stream-bronze")
    ev, first, second = _event_batches(spark, sf)
    for i, part in enumerate((first, second), 1):
        _land(part, f"{root}/landing", i)
        stream.stream_bronze(spark, f"{root}/landing/*", ev.schema, f"{root}/bronze",
                             f"{root}/_checkpoints/bronze")
    stream.stream_bronze(spark, f"{root}/landing/*", ev.schema, f"{root}/bronze",
                         f"{root}/_checkpoints/bronze")  # nothing new: no rows added
    return clean.drop_metadata(spark.read.parquet(f"{root}/bronze"))


def q_stream_dedup(spark, sf):
    root = _root(spark, "stream-dedup")
    ev, first, second = _event_batches(spark, sf)
    replays = first.filter(F.col("event_id") % 10 == 0)  # re-delivered copies
    for i, part in enumerate((first, second.unionByName(replays)), 1):
        _land(part, f"{root}/landing", i)
        stream.stream_dedup(spark, f"{root}/landing/*", ev.schema, f"{root}/events",
                            f"{root}/_checkpoints/dedup", ["event_id"], "ts", "30 days")
    return spark.read.parquet(f"{root}/events")


def q_stream_scd2(spark, sf):
    root = _root(spark, "stream-scd2")
    name = scratch_name(spark, "databases", "gold") + ".dim_customer"
    schema = None
    v1 = silver_customers(spark, sf)
    for v, d in td.SNAPSHOT_DATES.items():
        snap = snapshot(spark, sf, v, v1).withColumn("snapshot_date", F.lit(d).cast("date"))
        schema = snap.schema
        _land(snap, f"{root}/landing", v)
        stream.stream_scd2(spark, f"{root}/landing/*", schema, root, "dim_customer", name,
                           f"{root}/_checkpoints/scd2")
    return spark.table(name)


QUERIES.update({
    "stream_bronze": q_stream_bronze,
    "stream_dedup": q_stream_dedup,
    "stream_scd2": q_stream_scd2,
})


# --- generator (keys come from the shared tables) --------------------------------

def q_seed_customers(spark, sf):
    return datagen.seed_customers(td.table(spark, sf, "customer").select("c_custkey"), "c_custkey")


def q_seed_products(spark, sf):
    return datagen.seed_products(td.table(spark, sf, "part").select("p_partkey"), "p_partkey")


def _seed_orders(spark, sf):
    n_cust = td.table(spark, sf, "customer").count()
    return datagen.seed_orders(td.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", n_cust)


def q_seed_orders(spark, sf):
    return _seed_orders(spark, sf)


def q_seed_order_items(spark, sf):
    n_prod = td.table(spark, sf, "part").count()
    return datagen.seed_order_items(_seed_orders(spark, sf), n_prod)


def q_seed_inventory(spark, sf):
    return datagen.seed_inventory(q_seed_products(spark, sf))


QUERIES.update({
    "seed_customers": q_seed_customers,
    "seed_products": q_seed_products,
    "seed_orders": q_seed_orders,
    "seed_order_items": q_seed_order_items,
    "seed_inventory": q_seed_inventory,
})
