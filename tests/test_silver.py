"""Silver cleaning: expected values are derived from the rules in the tests."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemart.config import VALID_TIERS
from tidemart.operators.clean import calculate_line_total, clean_customers, clean_orders, dedup_latest
from tidemart.operators.quality import dq_bucket, quarantine_invalid, undetermined

CUSTOMER = "customer_id long, first_name string, last_name string, email string, loyalty_tier string, updated_at timestamp"
ORDER = "order_id long, customer_id long, order_status string, shipping_cost double, updated_at timestamp"
ITEM = "order_item_id string, order_id long, product_id long, quantity int, unit_price {p}, discount_pct {d}"
T0 = datetime(2031, 7, 4, 6)


def at(hours):
    return T0 + timedelta(hours=hours)


def test_newest_row_of_each_customer_wins(spark):
    # customer k is loaded k times, an hour apart; the last load carries its number as first name
    rows = [(k, f"load{i}", "z", "q@r.st", "gold", at(i)) for k in range(1, 6) for i in range(k)]
    got = {r["customer_id"]: r["first_name"] for r in clean_customers(spark.createDataFrame(rows, CUSTOMER)).collect()}
    assert got == {k: f"Load{k - 1}" for k in range(1, 6)}


def test_a_null_timestamp_wins_only_alone(spark):
    rows = [(1, "dated", "z", None, None, at(0)), (1, "undated", "z", None, None, None), (2, "only", "z", None, None, None)]
    got = {r["customer_id"]: r["first_name"] for r in clean_customers(spark.createDataFrame(rows, CUSTOMER)).collect()}
    assert got == {1: "Dated", 2: "Only"}


@pytest.mark.parametrize("raw", ["mIRA", " mira ", "MIRA", "o'neil-BRANDT", "de la CRUZ"])
def test_names_are_trimmed_and_title_cased(spark, raw):
    out = clean_customers(spark.createDataFrame([(9, raw, raw, None, None, at(1))], CUSTOMER)).first()
    want = " ".join(w[:1].upper() + w[1:].lower() for w in raw.strip().split(" "))
    assert (out["first_name"], out["last_name"]) == (want, want)


def test_tiers_outside_the_domain_become_the_lowest(spark):
    raw = [*(f" {t.lower()} " for t in VALID_TIERS), "diamond", "", None, "gold!", "GOLD"]
    df = spark.createDataFrame([(i, "a", "b", None, t, at(i)) for i, t in enumerate(raw)], CUSTOMER)
    got = {r["customer_id"]: r["loyalty_tier"] for r in clean_customers(df).collect()}
    assert got == {i: (t.strip().upper() if t and t.strip().upper() in VALID_TIERS else VALID_TIERS[0])
                   for i, t in enumerate(raw)}


def test_emails_are_flagged_and_kept(spark):
    mails = {"  Kim.Oh+x@Mail.Example.ORG ": True, "kim@localhost": False, "kim.example.org": False, "": False,
             "a b@c.de": False, "x@y.z": False, "x_1%@y-2.info": True}
    df = spark.createDataFrame([(i, "a", "b", m, None, at(i)) for i, m in enumerate([*mails, None])], CUSTOMER)
    got = {r["customer_id"]: (r["email"], r["is_email_valid"]) for r in clean_customers(df).collect()}
    assert got == {i: (m.strip().lower(), ok) for i, (m, ok) in enumerate(mails.items())} | {len(mails): (None, None)}
    strict = {r["customer_id"]: r["is_email_valid"] for r in clean_customers(df, null_email_invalid=True).collect()}
    assert strict[len(mails)] is False


def test_orders_split_by_validity(spark):
    # every combination of a customer (or none) with a cost (negative, zero, positive, none)
    combos = [(c, s) for c in (70, None) for s in (-0.01, 0.0, 12.5, None)]
    df = spark.createDataFrame([(500 + i, c, "  shipped", s, at(i)) for i, (c, s) in enumerate(combos)], ORDER)
    cleaned = clean_orders(df)
    assert {r["order_status"] for r in cleaned.collect()} == {"SHIPPED"}
    fits = {500 + i for i, (c, s) in enumerate(combos) if c is not None and s is not None and s >= 0}
    unknown = {500 + i for i, (c, s) in enumerate(combos) if c is not None and s is None}
    ids = lambda d: {r["order_id"] for r in d.collect()}
    valid, bad = quarantine_invalid(cleaned)
    assert ids(valid) == fits and ids(bad) == {500 + i for i in range(len(combos))} - fits
    assert "_dq_valid" not in valid.columns and "_dq_valid" not in bad.columns
    assert ids(undetermined(cleaned)) == unknown
    _, dropped = quarantine_invalid(cleaned, null_flag="drop")
    assert ids(dropped) == ids(bad) - unknown
    lenient, _ = quarantine_invalid(cleaned, null_flag="valid")
    assert ids(lenient) == fits | unknown
    # the job's one-pass split routes rows as the function does
    routed = cleaned.withColumn("b", dq_bucket(null_flag="quarantine"))
    assert ids(routed.where("b = 'valid'")) == fits and ids(routed.where("b = 'quarantine'")) == ids(bad)
    with pytest.raises(ValueError):
        quarantine_invalid(cleaned, null_flag="maybe")


@pytest.mark.parametrize("price,discount", [("decimal(12,2)", "decimal(5,2)"), ("decimal(18,6)", "decimal(9,4)"),
                                            ("double", "double")])
def test_line_totals_follow_the_formula(spark, price, discount):
    cells = [(3, "7.10", "0"), (1, "80", "12.5"), (0, "5", "5"), (12, "0.99", "100"), (7, "19.95", "33")]
    if price != "decimal(12,2)":  # finer than cents and per cent
        cells += [(1000, "0.005", "0"), (100, "10", "0.125"), (3, "1.234567", "7.5")]
    df = spark.createDataFrame([(str(i), 1, 1, q, p, d) for i, (q, p, d) in enumerate(cells)],
                               ITEM.format(p="string", d="string"))
    df = df.withColumns({"unit_price": F.col("unit_price").cast(price), "discount_pct": F.col("discount_pct").cast(discount)})
    got = {r["order_item_id"]: r["line_total"] for r in calculate_line_total(df).collect()}
    for i, (q, p, d) in enumerate(cells):
        assert got[str(i)] == pytest.approx(round(q * float(p) * (1 - float(d) / 100) + 1e-9, 2), abs=1e-9)


def test_ties_are_broken_the_same_way_on_every_run(spark):
    rows = [(1, c, at(0)) for c in "dbca"] * 3
    df = spark.createDataFrame(rows, "k long, v string, t timestamp")
    assert {dedup_latest(df.repartition(n), ["k"], ["t"]).first()["v"] for n in (1, 2, 5)} == {"a"}
