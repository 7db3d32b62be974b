"""Equivalent SQL (DuckDB dialect) for every registered query.

The CTEs below restate the adapter rules of ``tidemart.sources.testdata`` and
the operator semantics in plain SQL; DuckDB evaluates them independently of
Spark on the same parquet tables.
"""

from __future__ import annotations

EMAIL_RE = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
TRACKED = ("loyalty_tier", "address", "city", "state", "postal_code", "email")


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _hash(cols=TRACKED, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    parts = ", ".join(f"coalesce(CAST({p}{c} AS VARCHAR), 'NULL')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def _rot(x: str) -> str:
    return (f"CASE {x} WHEN 'BRONZE' THEN 'SILVER' WHEN 'SILVER' THEN 'GOLD' "
            f"WHEN 'GOLD' THEN 'PLATINUM' ELSE 'BRONZE' END")


def _cust_shape(day_offset: int, tier: str) -> str:
    return f"""
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 3 = 0 THEN ' jOHN ' WHEN c_custkey % 3 = 1 THEN 'MARY-jane' ELSE 'ann  lee' END AS first_name,
    CASE WHEN c_custkey % 4 = 0 THEN upper(n_name) ELSE lower(n_name) END AS last_name,
    CASE WHEN c_custkey % 33 = 0 THEN NULL WHEN c_custkey % 20 = 0 THEN 'not-an-email'
         ELSE ' C' || CAST(c_custkey AS VARCHAR) || '@Example.com' END AS email,
    CAST(c_custkey % 997 AS VARCHAR) || ' Main St' AS address,
    n_name AS city, r_name AS state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
    'USA' AS country,
    {tier} AS loyalty_tier,
    TIMESTAMP '2025-06-01 00:00:00' AS created_at,
    CAST(DATE '2026-01-01' + CAST(c_custkey % 90 + {day_offset} AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM cust_base"""


_SEGMENT_TIER = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'BRONZE' WHEN 'AUTOMOBILE' THEN ' silver ' "
                 "WHEN 'MACHINERY' THEN 'Gold' WHEN 'HOUSEHOLD' THEN 'PLATINUM' ELSE 'NOT_A_REAL_TIER' END")

_SRC_COLS = "customer_id, loyalty_tier, address, city, state, postal_code, email, first_name, last_name, country"


def _merge_step(prev: str, src: str, as_of: str, key: str = "customer_id",
                sk: str = "customer_sk", tracked=TRACKED, deleted: str | None = None,
                refresh: tuple[str, ...] = (), changes_only: bool = False) -> str:
    """One SCD2 merge written as four SQL branches (history/keep/expire/new)."""
    dele = f"coalesce(s.{deleted}, FALSE)" if deleted else "FALSE"
    s_cols = f"s.* EXCLUDE ({deleted})" if deleted else "s.*"
    keep_sel = "cur.*"
    if refresh:
        repl = ", ".join(f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE cur.{c} END AS {c}" for c in refresh)
        keep_sel = f"cur.* REPLACE ({repl})"
    expire = f"""SELECT cur.* REPLACE (DATE '{as_of}' - 1 AS effective_end_date, FALSE AS is_current)
    {", 'expire' AS _change" if changes_only else ""}
    FROM cur JOIN s ON cur.{key} = s.{key} WHERE s.row_hash <> cur.row_hash OR {dele}"""
    new = f"""SELECT n.*, CAST((SELECT m FROM m) + row_number() OVER (ORDER BY n.{key}) AS BIGINT) AS {sk},
         DATE '{as_of}' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
         TRUE AS is_current {", 'insert' AS _change" if changes_only else ""}
    FROM (SELECT {s_cols} FROM s LEFT JOIN cur ON cur.{key} = s.{key}
           WHERE NOT {dele} AND (cur.{key} IS NULL OR cur.row_hash <> s.row_hash)) n"""
    head = f"""(
  WITH s AS (SELECT *, {_hash(tracked)} AS row_hash FROM {src}),
       cur AS (SELECT * FROM {prev} WHERE is_current),
       m AS (SELECT coalesce(max({sk}), 0) AS m FROM {prev})
"""
    if changes_only:
        update = ""
        if refresh:
            differs = " OR ".join(f"s.{c} IS DISTINCT FROM cur.{c}" for c in refresh)
            update = f"""  UNION ALL BY NAME
  SELECT {keep_sel}, 'update' AS _change FROM cur JOIN s ON cur.{key} = s.{key}
   WHERE s.row_hash = cur.row_hash AND NOT {dele} AND ({differs})
"""
        return head + f"  {expire}\n  UNION ALL BY NAME\n  {new}\n{update})"
    return head + f"""  SELECT * FROM {prev} WHERE NOT is_current
  UNION ALL BY NAME
  SELECT {keep_sel} FROM cur LEFT JOIN s ON cur.{key} = s.{key}
   WHERE s.{key} IS NULL OR (s.row_hash = cur.row_hash AND NOT {dele})
  UNION ALL BY NAME
  {expire}
  UNION ALL BY NAME
  {new}
)"""


def _product_shape(version: int) -> str:
    if version == 1:
        name, price, day, where = ("p_name", "CAST(p_retailprice AS DECIMAL(10,2))", "p_partkey % 60", "")
    else:
        name = "CASE WHEN p_partkey % 8 = 0 THEN p_name || ' v2' ELSE p_name END"
        price = ("CAST(CASE WHEN p_partkey % 6 = 0 THEN round(CAST(p_retailprice AS DECIMAL(10,2)) "
                 "* CAST(1.10 AS DECIMAL(3,2)), 2) ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DECIMAL(10,2))")
        day, where = "p_partkey % 60 + 90", "WHERE p_partkey % 4 <> 3"
    return f"""SELECT p_partkey AS product_id, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(6, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS sku,
    {name} AS product_name, p_type AS category, p_brand AS subcategory, {price} AS unit_price,
    TIMESTAMP '2025-06-01 00:00:00' AS created_at,
    CAST(DATE '2026-01-01' + CAST({day} AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM part {where}"""


PRODUCT_TRACKED = ("unit_price", "category", "subcategory")
ORDER_RULES = (
    ("customer_present", "customer_id IS NOT NULL"),
    ("shipping_non_negative", "shipping_cost >= 0"),
    ("status_in_domain", "upper(trim(order_status)) IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')"),
    ("order_date_present", "order_date IS NOT NULL"),
)


PRELUDE = f"""
WITH
geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
cust_base AS (SELECT c.*, g.n_name, g.r_name FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey),
customers_raw AS (
  {_cust_shape(0, _SEGMENT_TIER)}
  UNION ALL
  {_cust_shape(30, "'gold'")}
  WHERE c_custkey % 10 = 0
),
customers_clean AS (
  SELECT * FROM (
    SELECT customer_id, {_initcap('first_name')} AS first_name, {_initcap('last_name')} AS last_name,
      lower(trim(email)) AS email, address, city, state, postal_code, country,
      CASE WHEN upper(trim(loyalty_tier)) IN ('BRONZE', 'SILVER', 'GOLD', 'PLATINUM')
           THEN upper(trim(loyalty_tier)) ELSE 'BRONZE' END AS loyalty_tier,
      created_at, updated_at,
      regexp_matches(lower(trim(email)), '{EMAIL_RE}') AS is_email_valid
    FROM customers_raw)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST) = 1
),
src_v1 AS (SELECT {_SRC_COLS} FROM customers_clean),
src_v2 AS (
  SELECT customer_id,
    CASE WHEN customer_id % 7 = 0 THEN {_rot('loyalty_tier')} ELSE loyalty_tier END AS loyalty_tier,
    address, city, state, postal_code, email,
    CASE WHEN customer_id % 11 = 0 THEN first_name || 'x' ELSE first_name END AS first_name,
    last_name, country
  FROM src_v1 WHERE customer_id % 13 <> 0
  UNION ALL BY NAME
  SELECT * REPLACE (-customer_id - 1 AS customer_id) FROM src_v1 WHERE customer_id % 17 = 0
),
src_v3 AS (
  SELECT customer_id,
    CASE WHEN customer_id % 5 = 0 THEN {_rot('t2')} ELSE t2 END AS loyalty_tier,
    address,
    CASE WHEN customer_id % 26 = 0 THEN city || ' North' ELSE city END AS city,
    state, postal_code, email,
    CASE WHEN customer_id % 11 = 0 THEN first_name || 'x' ELSE first_name END AS first_name,
    last_name, country
  FROM (SELECT *, CASE WHEN customer_id % 7 = 0 THEN {_rot('loyalty_tier')} ELSE loyalty_tier END AS t2
        FROM src_v1)
  UNION ALL BY NAME
  SELECT * REPLACE (-customer_id - 1 AS customer_id) FROM src_v1 WHERE customer_id % 17 = 0
),
dim1 AS (
  SELECT *, {_hash()} AS row_hash,
    CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_sk,
    DATE '2026-01-01' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
    TRUE AS is_current
  FROM src_v1
),
dim2 AS {_merge_step('dim1', 'src_v2', '2026-03-01')},
dim3 AS {_merge_step('dim2', 'src_v3', '2026-04-01')},
orders_base AS (
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'cancelled' WHEN o_orderkey % 89 = 0 THEN 'RETURNED '
         WHEN o_orderstatus = 'F' THEN ' delivered ' WHEN o_orderstatus = 'O' THEN 'Placed'
         ELSE 'shipped ' END AS order_status,
    CAST(DATE '2025-12-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 180 AS INTEGER)
         AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS order_date,
    CAST(CASE WHEN o_orderkey % 40 = 0 THEN -1 WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderkey % 25 END
         AS DECIMAL(10,2)) AS shipping_cost
  FROM orders
),
orders_raw AS (
  SELECT *, order_date + INTERVAL 1 HOUR AS updated_at FROM orders_base
  UNION ALL BY NAME
  SELECT * REPLACE ('shipped' AS order_status), order_date + INTERVAL 1 HOUR + INTERVAL 5 DAY AS updated_at
  FROM orders_base WHERE order_id % 9 = 0
),
orders_clean AS (
  SELECT * FROM (
    SELECT order_id, customer_id, upper(trim(order_status)) AS order_status, order_date, shipping_cost,
      updated_at, (customer_id IS NOT NULL AND shipping_cost >= 0) AS _dq_valid
    FROM orders_raw)
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS LAST) = 1
),
orders_valid AS (SELECT * EXCLUDE (_dq_valid) FROM orders_clean WHERE _dq_valid),
items_raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id,
    l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS discount_pct
  FROM lineitem
),
items_silver AS (
  SELECT *, CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price * (CAST(100 AS DECIMAL(3,0)) - discount_pct)
                       * CAST(0.01 AS DECIMAL(2,2)), 2) AS DOUBLE) AS line_total
  FROM items_raw
),
items_once AS (
  SELECT * FROM items_silver
  QUALIFY row_number() OVER (PARTITION BY order_item_id
                             ORDER BY order_id, product_id, quantity, unit_price, discount_pct) = 1
),
products_v1 AS ({_product_shape(1)}),
products_v2 AS ({_product_shape(2)}),
product_type1 AS (
  SELECT * FROM (SELECT * FROM products_v1 UNION ALL BY NAME SELECT * FROM products_v2)
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC NULLS LAST) = 1
),
psrc_v1 AS (SELECT product_id, unit_price, category, subcategory, sku, product_name FROM products_v1),
psrc_v2 AS (SELECT product_id, unit_price, category, subcategory, sku, product_name FROM products_v2),
pdim1 AS (
  SELECT *, {_hash(PRODUCT_TRACKED)} AS row_hash,
    CAST(row_number() OVER (ORDER BY product_id) AS BIGINT) AS product_sk,
    DATE '2026-01-01' AS effective_start_date, DATE '9999-12-31' AS effective_end_date,
    TRUE AS is_current
  FROM psrc_v1
),
pdim2 AS {_merge_step('pdim1', 'psrc_v2', '2026-04-01', 'product_id', 'product_sk', PRODUCT_TRACKED)},
src_del AS (SELECT *, customer_id % 19 = 0 AS is_deleted FROM src_v2),
src_del3 AS (SELECT *, customer_id % 23 = 0 AS is_deleted FROM src_v3),
ddel2 AS {_merge_step('dim1', 'src_del', '2026-03-01', deleted='is_deleted')},
ddel3 AS {_merge_step('ddel2', 'src_del3', '2026-04-01', deleted='is_deleted')},
snaps AS (
  SELECT *, DATE '2026-01-01' AS snapshot_date FROM src_v1
  UNION ALL BY NAME SELECT *, DATE '2026-03-01' AS snapshot_date FROM src_v2
  UNION ALL BY NAME SELECT *, DATE '2026-04-01' AS snapshot_date FROM src_v3
),
change_points AS (
  SELECT * FROM (SELECT *, {_hash()} AS row_hash FROM snaps)
  QUALIFY lag(row_hash) OVER (PARTITION BY customer_id ORDER BY snapshot_date) IS DISTINCT FROM row_hash
),
backfill AS (
  SELECT * EXCLUDE (snapshot_date), snapshot_date AS effective_start_date,
    coalesce(lead(snapshot_date) OVER w - 1, DATE '9999-12-31') AS effective_end_date,
    lead(snapshot_date) OVER w IS NULL AS is_current,
    CAST(row_number() OVER (ORDER BY snapshot_date, customer_id) AS BIGINT) AS customer_sk
  FROM change_points
  WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_date)
),
dim_asof AS (
  SELECT customer_id, customer_sk, loyalty_tier,
    CASE WHEN row_number() OVER (PARTITION BY customer_id ORDER BY effective_start_date) = 1
         THEN DATE '0001-01-01' ELSE effective_start_date END AS vstart,
    effective_end_date AS vend
  FROM dim3
),
fact_asof AS (
  SELECT i.order_id, i.order_item_id, d.customer_sk, i.product_id, o.order_date, o.order_status,
    i.quantity, i.unit_price, i.discount_pct, i.line_total, d.loyalty_tier
  FROM items_silver i JOIN orders_valid o ON i.order_id = o.order_id
  JOIN dim_asof d ON o.customer_id = d.customer_id AND CAST(o.order_date AS DATE) BETWEEN d.vstart AND d.vend
),
copies AS (
  SELECT * FROM customers_raw
  UNION ALL BY NAME
  SELECT * REPLACE (-customer_id - 1 AS customer_id) FROM customers_raw WHERE customer_id % 250 = 7
),
fact_current AS (
  SELECT i.order_id, i.order_item_id, d.customer_sk, i.product_id, o.order_date, o.order_status,
    i.quantity, i.unit_price, i.discount_pct, i.line_total, d.loyalty_tier
  FROM items_silver i JOIN orders_valid o ON i.order_id = o.order_id
  JOIN (SELECT * FROM dim3 WHERE is_current) d ON o.customer_id = d.customer_id
)
"""

_REVENUE = ("SELECT loyalty_tier, CAST(SUM(CAST(line_total AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
            "FROM {src} GROUP BY loyalty_tier ORDER BY revenue DESC")

FINAL = {
    "clean_customers": "SELECT * FROM customers_clean",
    "clean_orders": "SELECT * FROM orders_clean",
    "orders_valid": "SELECT * FROM orders_valid",
    "orders_quarantine": "SELECT * EXCLUDE (_dq_valid) FROM orders_clean WHERE _dq_valid IS NOT TRUE",
    "orders_undetermined": "SELECT * EXCLUDE (_dq_valid) FROM orders_clean WHERE _dq_valid IS NULL",
    "line_total": "SELECT * FROM items_silver",
    "row_hash": f"SELECT customer_id, {_hash()} AS row_hash FROM src_v1",
    "scd2_initialize": "SELECT * FROM dim1",
    "scd2_merge_v2": "SELECT * FROM dim2",
    "scd2_merge_v3": "SELECT * FROM dim3",
    "fact_sales_current": "SELECT * FROM fact_current",
    "revenue_by_tier": _REVENUE.format(src="fact_current"),
}


def _ri(name, child, ck, parent, pk):
    return (f"SELECT '{name}' AS check_name, CAST(c.{ck} AS BIGINT) AS key_value, "
            f"CAST(count(*) AS BIGINT) AS n_rows FROM {child} c WHERE c.{ck} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck}) GROUP BY c.{ck}")


def _dups(name, tbl, k):
    return (f"SELECT '{name}' AS table_name, CAST({k} AS VARCHAR) AS key_value, "
            f"CAST(count(*) AS BIGINT) AS n_rows FROM {tbl} GROUP BY {k} HAVING count(*) > 1")


_CD_ATTRS = ("first_name", "last_name", "email", "address", "city", "state", "postal_code", "loyalty_tier")

FINAL.update({
    "scd2_backfill": "SELECT * FROM backfill",
    "scd2_changes": "SELECT * FROM " + _merge_step("dim2", "src_v3", "2026-04-01", changes_only=True),
    "scd2_deletes": "SELECT * FROM " + _merge_step("dim1", "src_del", "2026-03-01", deleted="is_deleted"),
    "scd2_backfill_deletes": "SELECT * FROM ddel3",
    "scd2_changes_refresh": "SELECT * FROM " + _merge_step(
        "dim1", "src_v2", "2026-03-01", refresh=("first_name", "last_name", "country"), changes_only=True),
    "scd2_refresh_passthrough": "SELECT * FROM " + _merge_step(
        "dim1", "src_v2", "2026-03-01", refresh=("first_name", "last_name", "country")),
    "dim_product_type1": "SELECT * FROM product_type1",
    "dim_product_scd2": "SELECT * FROM pdim2",
    "fact_sales_as_of": "SELECT * FROM fact_asof",
    "fact_sales_product": ("SELECT f.*, p.sku, p.category, p.subcategory FROM fact_current f "
                           "LEFT JOIN product_type1 p ON f.product_id = p.product_id"),
    "revenue_by_tier_as_of": _REVENUE.format(src="fact_asof"),
    "ri_orphans": " UNION ALL ".join([
        _ri("order_items.order_id->orders_valid", "items_raw", "order_id", "orders_valid", "order_id"),
        _ri("order_items.product_id->products", "items_raw", "product_id",
            "(SELECT * FROM products_v1 WHERE product_id % 29 <> 0)", "product_id"),
        _ri("orders.customer_id->customers", "orders_raw", "customer_id",
            "(SELECT * FROM customers_raw WHERE customer_id % 31 <> 0)", "customer_id"),
        _ri("inventory.product_id->products", "(SELECT p_partkey AS product_id FROM part)", "product_id",
            "(SELECT * FROM products_v1 WHERE product_id % 29 <> 0)", "product_id"),
    ]),
    "key_uniqueness": " UNION ALL ".join([
        _dups("customers", "customers_raw", "customer_id"),
        _dups("orders", "orders_raw", "order_id"),
        _dups("order_items", "items_raw", "order_item_id"),
        _dups("products", "products_v1", "product_id"),
        _dups("products.sku", "products_v1", "sku"),
        _dups("products.sku of both versions",
              "(SELECT sku FROM products_v1 UNION ALL SELECT sku FROM products_v2)", "sku"),
        _dups("inventory", "(SELECT p_partkey AS inventory_id FROM part)", "inventory_id"),
    ]),
    "not_null_summary": " UNION ALL ".join(
        f"SELECT '{name}.{c}' AS rule, CAST(count(*) AS BIGINT) AS rows_checked, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS rows_failed FROM {src}"
        for name, src, columns in (
            ("customers", "customers_raw", ("customer_id",)),
            ("products", "products_v1", ("product_id",)),
            ("orders", "orders_raw", ("order_id", "customer_id", "order_date")),
            ("order_items", "items_raw", ("order_item_id", "order_id", "product_id", "quantity", "unit_price")),
            ("inventory", "(SELECT p_partkey AS inventory_id, p_partkey AS product_id FROM part)",
             ("inventory_id", "product_id")))
        for c in columns),
    "expectations_summary": " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(count(*) AS BIGINT) AS rows_checked, "
        f"CAST(sum(CASE WHEN coalesce({r}, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS rows_failed FROM orders_raw"
        for n, r in ORDER_RULES),
    "orders_failed_rules": (
        "SELECT order_id, updated_at, failed_rules, failed_rules = '' AS _dq_valid FROM ("
        "SELECT order_id, updated_at, concat_ws(',', "
        + ", ".join(f"CASE WHEN coalesce({r}, FALSE) THEN NULL ELSE '{n}' END" for n, r in ORDER_RULES)
        + ") AS failed_rules FROM orders_raw)"),
    "content_duplicates": (
        "SELECT " + ", ".join(f"lower(trim(CAST({a} AS VARCHAR))) AS {a}" for a in _CD_ATTRS)
        + ", min(customer_id) AS keep_id, CAST(count(*) AS BIGINT) AS n_rows, "
        "CAST(count(DISTINCT customer_id) AS BIGINT) AS n_ids FROM copies GROUP BY "
        + ", ".join(str(i + 1) for i in range(len(_CD_ATTRS)))
        + " HAVING count(DISTINCT customer_id) > 1"),
})

_EV_CUT = "TIMESTAMP '2024-01-15 00:00:00'"
FINAL.update({
    "full_extract": "SELECT * FROM products_v1",
    "incremental_extract": f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {_EV_CUT})",
    "watermark_max": (
        f"SELECT 'events' AS table_name, max(ts) AS watermark_ts, CAST(count(*) AS BIGINT) AS rows_extracted "
        f"FROM events WHERE ts <= {_EV_CUT} UNION ALL "
        f"SELECT 'events', max(ts), CAST(count(*) AS BIGINT) FROM events "
        f"WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {_EV_CUT})"),
    "extract_run_audit": (
        f"SELECT 'events' AS table_name, 'incremental' AS mode, CAST(count(*) AS BIGINT) AS rows_extracted, "
        f"'run1' AS run_id, '2024-01-15' AS run_date FROM events WHERE ts <= {_EV_CUT} UNION ALL "
        f"SELECT 'events', 'incremental', CAST(count(*) AS BIGINT), 'run2', '2024-01-31' FROM events "
        f"WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {_EV_CUT})"),
    "raw_roundtrip": "SELECT * FROM orders_raw",
    "bronze_append_merge_schema": (
        "SELECT *, CAST(NULL AS VARCHAR) AS segment, DATE '2026-01-01' AS load_date FROM customers_raw "
        "UNION ALL BY NAME "
        "SELECT *, upper(trim(loyalty_tier)) AS segment, DATE '2026-01-02' AS load_date FROM customers_raw"),
    "silver_passthrough": "SELECT * FROM product_type1",
    "snapshot_overwrite": "SELECT * FROM dim2",
    "dim_maxima": "SELECT max(customer_sk) AS max_sk, max(effective_start_date) AS max_start FROM dim2",
    "daily_batch_revenue": (
        "SELECT *, DATE '2026-01-01' AS run_date FROM ("
        + _REVENUE.format(src="""(
      SELECT i.line_total, d.loyalty_tier
      FROM items_once i JOIN orders_valid o ON i.order_id = o.order_id
      JOIN dim1 d ON o.customer_id = d.customer_id)""") + ")"),
    "daily_two_days_revenue": (
        "SELECT *, DATE '2026-06-02' AS run_date FROM ("
        + _REVENUE.format(src="""(
      SELECT CAST(round(CAST(quantity + CASE WHEN product_id % 11 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,0)) * unit_price
                  * (CAST(100 AS DECIMAL(3,0)) - discount_pct) * CAST(0.01 AS DECIMAL(2,2)), 2) AS DOUBLE) AS line_total,
        CASE WHEN c.customer_id % 7 = 0 THEN 'PLATINUM' ELSE c.loyalty_tier END AS loyalty_tier
      FROM items_once i JOIN orders_valid o ON i.order_id = o.order_id
      JOIN customers_clean c ON o.customer_id = c.customer_id)""") + ")"),
    "quality_audit": " UNION ALL ".join(  # day two brings the moved customers, no order, every item
        f"SELECT '{table}' AS table_name, '{day}' AS run_date, '{rule}' AS rule, CAST(count(*) AS BIGINT) AS rows_checked, "
        f"CAST(coalesce(sum(CASE WHEN coalesce({cond}, FALSE) THEN 0 ELSE 1 END), 0) AS BIGINT) AS rows_failed "
        f"FROM {src} WHERE {brought}"
        for day, of_customers, of_orders in (("2026-05-01", "TRUE", "TRUE"), ("2026-06-02", "customer_id % 7 = 0", "FALSE"))
        for table, src, brought, rules in (
            ("customers", "customers_clean", of_customers, (("email_valid", "is_email_valid"),)),
            ("orders", "orders_clean", of_orders, (("customer_present", "customer_id IS NOT NULL"),
                                                   ("shipping_non_negative", "shipping_cost >= 0"),
                                                   ("order_date_present", "order_date IS NOT NULL"))),
            ("order_items", "items_once", "TRUE", (("line_total_present", "line_total IS NOT NULL"),
                                                   ("quantity_positive", "quantity > 0"))))
        for rule, cond in rules),
    "bronze_widened_type": (
        "SELECT order_item_id, CAST(quantity AS BIGINT) AS quantity, CAST(CAST(unit_price AS DECIMAL(10,2)) AS DECIMAL(14,4)) "
        "AS unit_price, DATE '2026-01-01' AS load_date FROM items_raw UNION ALL "
        "SELECT order_item_id, CAST(quantity AS BIGINT) + 3000000000, CAST(CAST(unit_price AS DECIMAL(10,2)) + "
        "CAST('0.125' AS DECIMAL(3,3)) AS DECIMAL(14,4)), DATE '2026-01-02' FROM items_raw"),
    "publish_evolves": "SELECT *, lower(loyalty_tier) AS segment FROM src_v2",
    "incremental_extract_by_id": (
        "SELECT * FROM events WHERE event_id > (SELECT max(event_id) FROM events "
        "WHERE event_id <= (SELECT max(event_id) // 2 FROM events))"),
})

FINAL.update({
    "stream_bronze": "SELECT * FROM events",
    "stream_dedup": "SELECT * FROM events",
    "stream_scd2": "SELECT * FROM dim3",
})


# --- generator: the same md5-based draws, in SQL ---------------------------------

from tidemart.config import ORDER_STATUSES as _STATUSES, VALID_TIERS as _TIERS  # noqa: E402
from tidemart.operators.datagen import (  # noqa: E402
    CATEGORIES as _CATS,
    DISCOUNTS as _DISC,
    SYLLABLES as _SYL,
    WAREHOUSES as _WH,
)


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _gh(k: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', CAST({k} AS VARCHAR), '{salt}')), 1, 15)) AS BIGINT)"


def _gpick(k, salt, values) -> str:
    return f"([{', '.join(_q(v) for v in values)}])[CAST({_gh(k, salt)} % {len(values)} + 1 AS INTEGER)]"


def _gint(k, salt, lo, hi) -> str:
    return f"CAST({_gh(k, salt)} % {hi - lo + 1} + {lo} AS INTEGER)"


def _gmoney(k, salt, lo, hi) -> str:
    return (f"CAST(CAST({_gh(k, salt)} % {(hi - lo) * 100 + 1} + {lo * 100} AS DECIMAL(10,0)) "
            f"* CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(10,2))")


def _gword(k, salt, parts=2) -> str:
    w = " || ".join(_gpick(k, f"{salt}{i}", _SYL) for i in range(parts))
    return f"(upper(substr({w}, 1, 1)) || substr({w}, 2))"


def _seed_customers_sql() -> str:
    k = "c_custkey"
    dirty = f"({_gh(k, 'dirty')} % 10000 < 500)"
    last = _gword(k, "last", 3)
    base = f"""SELECT CAST({k} + 1 AS BIGINT) AS customer_id,
    {_gword(k, 'first')} AS first_name,
    CASE WHEN {dirty} THEN upper({last}) ELSE {last} END AS last_name,
    CASE WHEN {dirty} AND {_gh(k, 'nomail')} % 10000 < 3000 THEN NULL
         ELSE lower({_gword(k, 'mail')} || '.' || CAST({k} % 1000 AS VARCHAR) || '@example.com') END AS email,
    CAST({_gint(k, 'street', 1, 9999)} AS VARCHAR) || ' ' || {_gword(k, 'road')} || ' St' AS address,
    {_gword(k, 'city', 3)} AS city,
    upper(substr({_gword(k, 'state')}, 1, 2)) AS state,
    lpad(CAST({_gint(k, 'zip', 0, 99999)} AS VARCHAR), 5, '0') AS postal_code,
    'USA' AS country,
    {_gpick(k, 'tier', list(_TIERS))} AS loyalty_tier
  FROM customer"""
    return f"""WITH base AS ({base}),
  dup AS (SELECT * FROM base ORDER BY {_gh('customer_id', 'dupe')}, customer_id LIMIT 5)
SELECT * FROM base
UNION ALL BY NAME
SELECT * REPLACE (CAST((SELECT max(customer_id) FROM base) + row_number() OVER (ORDER BY customer_id) AS BIGINT)
                  AS customer_id) FROM dup"""


def _seed_products_sql(src: str = "part") -> str:
    k = "p_partkey"
    cat = _gpick(k, "cat", list(_CATS))
    sub_case = " ".join(f"WHEN {_q(c)} THEN [{', '.join(_q(x) for x in ss)}]" for c, ss in _CATS.items())
    return f"""SELECT CAST({k} + 1 AS BIGINT) AS product_id,
    'SKU-' || lpad(CAST({k} + 1 AS VARCHAR), CAST(greatest(5, length(CAST({k} + 1 AS VARCHAR))) AS INTEGER), '0') AS sku,
    {_gword(k, 'adj')} || ' ' || {_gword(k, 'noun', 3)} AS product_name,
    {cat} AS category,
    (CASE {cat} {sub_case} END)[CAST({_gh(k, 'sub')} % 3 + 1 AS INTEGER)] AS subcategory,
    {_gmoney(k, 'price', 5, 800)} AS unit_price
  FROM {src}"""


def _seed_orders_sql() -> str:
    k = "o_orderkey"
    day = f"(DATE '2026-06-30' - {_gint(k, 'day', 0, 179)})"
    return f"""SELECT CAST({k} + 1 AS BIGINT) AS order_id,
    CAST({_gh(k, 'cust')} % (SELECT count(*) FROM customer) + 1 AS BIGINT) AS customer_id,
    {_gpick(k, 'status', list(_STATUSES))} AS order_status,
    CAST({day} AS TIMESTAMP) + to_hours(CAST({_gint(k, 'hh', 0, 23)} AS BIGINT))
      + to_minutes(CAST({_gint(k, 'mi', 0, 59)} AS BIGINT)) AS order_date,
    {_gmoney(k, 'ship', 0, 25)} AS shipping_cost
  FROM orders"""


def _seed_items_sql() -> str:
    lk = "(order_id * 8 + line)"
    return f"""WITH o AS ({_seed_orders_sql()}),
  l AS (SELECT order_id, unnest(range(1, {_gint('order_id', 'nitems', 1, 4)} + 1)) AS line FROM o)
SELECT CAST({lk} AS BIGINT) AS order_item_id, order_id,
    CAST({_gh(lk, 'prod')} % (SELECT count(*) FROM part) + 1 AS BIGINT) AS product_id,
    {_gint(lk, 'qty', 1, 5)} AS quantity,
    {_gmoney(lk, 'price', 5, 800)} AS unit_price,
    CAST({_gpick(lk, 'disc', _DISC)} AS DECIMAL(5,2)) AS discount_pct
  FROM l"""


def _seed_inventory_sql() -> str:
    p = "product_id"
    return f"""WITH p AS ({_seed_products_sql()})
SELECT {p} AS inventory_id, {p} AS product_id, {_gpick(p, 'wh', _WH)} AS warehouse_code,
    {_gint(p, 'onhand', 0, 500)} AS quantity_on_hand, {_gint(p, 'reorder', 5, 50)} AS reorder_level
  FROM p"""


SEED_SQL = {
    "seed_customers": _seed_customers_sql(),
    "seed_products": _seed_products_sql(),
    "seed_orders": _seed_orders_sql(),
    "seed_order_items": _seed_items_sql(),
    "seed_inventory": _seed_inventory_sql(),
}


_CD_NORM = ", ".join(f"lower(trim(CAST({a} AS VARCHAR))) AS {a}" for a in _CD_ATTRS)
FINAL["content_duplicate_map"] = (
    f"SELECT DISTINCT n.customer_id, g.keep_id FROM (SELECT customer_id, {_CD_NORM} FROM copies) n "
    f"JOIN (SELECT {_CD_NORM}, min(customer_id) AS keep_id FROM copies GROUP BY "
    + ", ".join(str(i + 1) for i in range(len(_CD_ATTRS)))
    + " HAVING count(DISTINCT customer_id) > 1) g ON "
    + " AND ".join(f"n.{a} IS NOT DISTINCT FROM g.{a}" for a in _CD_ATTRS)
    + " WHERE n.customer_id <> g.keep_id")


def oracle_sql() -> dict[str, str]:
    out = {k: PRELUDE + v for k, v in FINAL.items()}
    out.update(SEED_SQL)  # self-contained, no adapter CTEs needed
    return out
