"""Silver-layer cleaning: standardise, flag, keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import DQ_VALID, email_is_valid, line_total, normalize_tier, order_is_valid, title_case


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                 tie_breakers: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep one row per key: the first under ``order_by`` (newest first).

    ``order_by`` entries that are plain names sort descending with NULLs last,
    so a row with a NULL timestamp only wins when nothing else exists.
    Ties are broken by ``tie_breakers`` (default: the remaining columns,
    ascending), so the winner is deterministic across retries.

    Plan: ``row_number() = 1`` becomes a partial WindowGroupLimit before the
    shuffle, so even a key holding a third of all rows is cut down to one row
    per input partition before it is exchanged.
    """
    if tie_breakers is None:
        named = {*keys, *(c for c in order_by if isinstance(c, str))}
        tie_breakers = [c for c in df.columns if c not in named]
    newest = [c if isinstance(c, Column) else F.desc_nulls_last(c) for c in order_by]
    smallest = [c if isinstance(c, Column) else F.asc_nulls_last(c) for c in tie_breakers]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest, *smallest))
    return df.select("*", place.alias("_place")).where("_place = 1").select(*df.columns)


def drop_metadata(df: DataFrame, prefix: str = "_") -> DataFrame:
    """Drop load-metadata columns (``_extracted_at``, ``_source_file`` ...)."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def clean_customers(df: DataFrame, tie_breakers: Sequence[str] | None = None,
                    null_email_invalid: bool = False) -> DataFrame:
    """Standardise names, email and tier; flag bad emails; latest row per id.

    A missing email gives a NULL flag (original behaviour) unless
    ``null_email_invalid`` makes it false.
    """
    return dedup_latest(standard_customers(df, null_email_invalid), ["customer_id"], ["updated_at"], tie_breakers)


def standard_customers(df: DataFrame, null_email_invalid: bool = False) -> DataFrame:
    """Every row with standard names, email and tier and the email's flag."""
    df = df.withColumns({
        "first_name": title_case("first_name"),
        "last_name": title_case("last_name"),
        "email": F.lower(F.trim(F.col("email"))),
        "loyalty_tier": normalize_tier("loyalty_tier"),
    })
    flag = email_is_valid("email")
    if null_email_invalid:
        flag = F.coalesce(flag, F.lit(False))
    return df.withColumn("is_email_valid", flag)


def clean_orders(df: DataFrame, tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Upper-case status, the verdict of ``order_is_valid`` as ``_dq_valid``, latest row per order.

    A NULL verdict is routed by ``quarantine_invalid``.
    """
    return dedup_latest(flagged_orders(df), ["order_id"], ["updated_at"], tie_breakers)


def flagged_orders(df: DataFrame) -> DataFrame:
    """Every row with its status in upper case and the verdict ``_dq_valid``."""
    return df.withColumns({"order_status": F.upper(F.trim("order_status")), DQ_VALID: order_is_valid()})


def calculate_line_total(df: DataFrame) -> DataFrame:
    """Net line total after the percentage discount, in cents precision.

    Decimal and whole-number inputs of any scale are multiplied exactly;
    floating-point inputs follow the formula in doubles.
    """
    return df.withColumn("line_total", line_total(exact=exact_total(df)))


def exact_total(df: DataFrame) -> bool:
    """Whether the line total of ``df`` is worked out in decimals."""
    types = dict(df.dtypes)
    return all(types[c].startswith(("decimal", "int", "bigint", "smallint", "tinyint"))
               for c in ("quantity", "unit_price", "discount_pct"))
