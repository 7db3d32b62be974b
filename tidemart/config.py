"""Specs and fixed values shared by the operators.

The values under "fixed values" must stay exactly as written: they decide
which rows are valid and how change hashes are formed, so results only
match the original pipeline when they are equal.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's values)
# ---------------------------------------------------------------------------
VALID_TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
DEFAULT_TIER = "BRONZE"
ORDER_STATUSES = ("PLACED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
HASH_SEPARATOR = "||"
HASH_NULL_TOKEN = "NULL"
FAR_FUTURE_DATE = date(9999, 12, 31)

CUSTOMER_KEY = "customer_id"
CUSTOMER_TRACKED = ("loyalty_tier", "address", "city", "state", "postal_code", "email")
CUSTOMER_PASSTHROUGH = ("first_name", "last_name", "country")

FACT_SALES_COLUMNS = (
    "order_id", "order_item_id", "customer_sk", "product_id", "order_date",
    "order_status", "quantity", "unit_price", "discount_pct", "line_total",
    "loyalty_tier",
)

# SCD bookkeeping columns appended to every versioned dimension.
ROW_HASH = "row_hash"
START = "effective_start_date"
END = "effective_end_date"
CURRENT = "is_current"


@dataclass(frozen=True)
class ScdSpec:
    """Which columns key, version and ride along in a type-2 dimension."""

    business_key: str = CUSTOMER_KEY
    tracked: tuple[str, ...] = CUSTOMER_TRACKED
    passthrough: tuple[str, ...] = CUSTOMER_PASSTHROUGH
    sk_col: str = "customer_sk"
    # "carry": untracked columns keep the value of the version's first load
    # (the original behaviour); "refresh": current rows take the newest value.
    passthrough_mode: str = "carry"
    # Optional boolean source column; true expires the current version.
    deleted_col: str | None = None
    strict_hash: bool = False
    # A second change on the day a version started: "version" closes it the
    # day before (the original behaviour, an inverted interval); "replace"
    # overwrites that version in place, keeping its key and start date.
    same_day: str = "version"

    @property
    def source_columns(self) -> list[str]:
        cols = [self.business_key, *self.tracked, *self.passthrough]
        if self.deleted_col:
            cols.append(self.deleted_col)
        return cols


CUSTOMER_SCD = ScdSpec()
PRODUCT_SCD = ScdSpec(
    business_key="product_id",
    tracked=("unit_price", "category", "subcategory"),
    passthrough=("sku", "product_name"),
    sk_col="product_sk",
)


@dataclass(frozen=True)
class TableSpec:
    """How one source table is extracted."""

    name: str
    mode: str = "full"  # "full" | "incremental"
    watermark_col: str | None = None
    keys: tuple[str, ...] = ()  # primary key; silver keeps its newest load
    order_cols: tuple[str, ...] = ()  # newest first, after the load date
    inclusive: bool = False  # extract ">= watermark" instead of ">"


SOURCE_TABLES = (
    TableSpec("customers", "incremental", "updated_at", ("customer_id",), ("updated_at",)),
    TableSpec("products", "full", None, ("product_id",), ("updated_at",)),
    TableSpec("orders", "incremental", "updated_at", ("order_id",), ("updated_at",)),
    TableSpec("order_items", "full", None, ("order_item_id",), ()),
    TableSpec("inventory", "incremental", "updated_at", ("inventory_id",), ("updated_at",)),
)
