"""Column-expression builders (JVM-side built-ins only, no UDFs)."""

from tidemart.functions.columns import (  # noqa: F401
    DQ_VALID,
    ORDER_IS_VALID,
    email_is_valid,
    line_total,
    normalize_tier,
    order_is_valid,
    row_hash,
    title_case,
)
