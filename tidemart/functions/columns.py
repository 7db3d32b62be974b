"""Scalar expressions used by the cleaning and SCD operators.

All of them compile to Catalyst expressions, so they stay inside
whole-stage codegen; none of them needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.config import (
    DEFAULT_TIER,
    EMAIL_PATTERN,
    HASH_NULL_TOKEN,
    HASH_SEPARATOR,
    VALID_TIERS,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: str | Column) -> Column:
    """Trim spaces, lower-case, capitalise each space-separated word."""
    return F.initcap(F.trim(_c(c)))


def normalize_tier(c: str | Column, valid: Iterable[str] = VALID_TIERS,
                   default: str = DEFAULT_TIER) -> Column:
    """Upper-cased tier if it is in the domain, else the default (NULL too)."""
    norm = F.upper(F.trim(_c(c)))
    return F.when(norm.isin(list(valid)), norm).otherwise(F.lit(default))


def email_is_valid(c: str | Column) -> Column:
    """Pattern flag; NULL email gives a NULL flag."""
    return _c(c).rlike(EMAIL_PATTERN)


DQ_VALID = "_dq_valid"
#: what a valid order is; a part that is unknown makes the verdict unknown
ORDER_IS_VALID = "customer_id IS NOT NULL AND shipping_cost >= 0"


def order_is_valid() -> Column:
    """Verdict on an order: its customer is known and its shipping cost not negative (NULL where the cost is unknown)."""
    return F.expr(ORDER_IS_VALID)


def row_hash(cols: Iterable[str], strict: bool = False) -> Column:
    """SHA-256 over the tracked columns.

    Default form: values cast to string, NULL written as ``NULL``, joined with
    ``||`` -- identical bytes to the original change hash (so a NULL and the
    text ``NULL`` collide). ``strict=True`` hashes a JSON object instead, which
    keeps NULLs and separators apart.
    """
    cols = list(cols)
    if strict:
        body = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    else:
        body = F.concat_ws(
            HASH_SEPARATOR,
            *[F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL_TOKEN)) for c in cols],
        )
    return F.sha2(body, 256)


def line_total(quantity: str | Column = "quantity", unit_price: str | Column = "unit_price",
               discount_pct: str | Column = "discount_pct", exact: bool = True) -> Column:
    """quantity * unit_price * (1 - discount_pct / 100), rounded to cents, as double.

    ``exact``: the inputs are decimals or whole numbers and keep their own
    scale; the product is decimal arithmetic (the division by 100 written as a
    multiplication by 0.01), rounded HALF_UP. Otherwise the same formula in
    double arithmetic.
    """
    q, p, d = _c(quantity), _c(unit_price), _c(discount_pct)
    if not exact:
        q, p, d = (x.cast("double") for x in (q, p, d))
        return F.round(q * p * (F.lit(1.0) - d / F.lit(100.0)), 2)
    rest = (F.lit(100).cast("decimal(3,0)") - d) * F.lit(0.01).cast("decimal(2,2)")
    return F.round(q.cast("decimal(10,0)") * p * rest, 2).cast("double")
