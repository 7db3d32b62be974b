"""Data-quality operators: validity split, expectations, integrity checks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions import DQ_VALID
from tidemart.operators import bitmaps
from tidemart.session import materialize

DQ_BUCKET = "_dq_bucket"


def dq_bucket(flag_col: str = DQ_VALID, null_flag: str = "undetermined") -> Column:
    """'valid' / 'quarantine' for one row; a NULL flag gives ``null_flag``."""
    f = F.col(flag_col)
    return (F.when(f.isNull(), F.lit(null_flag))
             .when(f, F.lit("valid"))
             .otherwise(F.lit("quarantine")))


def quarantine_invalid(df: DataFrame, flag_col: str = DQ_VALID,
                       null_flag: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Split into (valid, quarantined) and drop the flag from both.

    ``null_flag`` decides rows whose flag is NULL: ``"quarantine"`` (default,
    nothing is lost), ``"drop"`` (neither output; the original behaviour),
    or ``"valid"``.
    """
    f = F.col(flag_col)
    valid_cond, bad_cond = f == True, f == False  # noqa: E712
    if null_flag == "quarantine":
        bad_cond = bad_cond | f.isNull()
    elif null_flag == "valid":
        valid_cond = valid_cond | f.isNull()
    elif null_flag != "drop":
        raise ValueError(f"null_flag must be quarantine|drop|valid, got {null_flag!r}")
    return df.filter(valid_cond).drop(flag_col), df.filter(bad_cond).drop(flag_col)


def undetermined(df: DataFrame, flag_col: str = DQ_VALID) -> DataFrame:
    """Rows whose validity flag is NULL (they fall between both outputs)."""
    return df.filter(F.col(flag_col).isNull()).drop(flag_col)


def apply_expectations(df: DataFrame, rules: Mapping[str, str | Column],
                       valid_col: str = DQ_VALID,
                       failed_col: str = "_dq_failed_rules") -> DataFrame:
    """Evaluate named boolean rules per row.

    Adds ``failed_col`` (array of the names of rules that are false or NULL)
    and ``valid_col`` (true when that array is empty). A NULL rule result
    counts as a failure, so no row slips through three-valued logic.
    """
    checks = []
    for name, rule in rules.items():
        cond = F.expr(rule) if isinstance(rule, str) else rule
        checks.append(F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(F.lit(name)))
    failed = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return df.withColumn(failed_col, failed).withColumn(valid_col, F.size(F.col(failed_col)) == 0)


def expectation_summary(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """One row per rule: rows checked, rows failing (NULL counts as failing).

    A single aggregation pass (partial aggregation on every partition), then
    unpivoted with ``stack`` -- no per-rule scan.
    """
    aggs = []
    for name, rule in rules.items():
        cond = F.expr(rule) if isinstance(rule, str) else rule
        aggs.append(F.sum(F.when(F.coalesce(cond, F.lit(False)), 0).otherwise(1))
                     .cast("bigint").alias(f"f_{name}"))
    wide = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows_checked"), *aggs)
    names = list(rules)
    stack = ", ".join(f"'{n}', `f_{n}`" for n in names)
    return wide.selectExpr("rows_checked", f"stack({len(names)}, {stack}) AS (rule, rows_failed)")


def observed(df: DataFrame, rules: Mapping[str, str | Column],
             among: Column | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that counts its rows and each rule's failures while ``df`` is written.

    No pass of its own: the counts are partial sums of the tasks that write (a
    rule that is NULL fails). Read them from the observation after the write.
    ``among`` (a flag that is never NULL) counts the rows where it is true alone.
    """
    told = Observation(f"rules-{uuid.uuid4().hex[:8]}")
    among = F.lit(True) if among is None else among
    counts = [F.count(F.when(among, 1)).alias("rows_checked")]
    for name, rule in rules.items():
        cond = F.expr(rule) if isinstance(rule, str) else rule
        counts.append(F.sum(F.when(~among | F.coalesce(cond, F.lit(False)), 0).otherwise(1)).alias(name))
    return df.observe(told, *counts), told


AUDIT_SCHEMA = "table_name string, run_date string, rule string, rows_checked bigint, rows_failed bigint"


def record_audit(spark: SparkSession, root: str, told: Sequence[tuple[str, str, Observation]]) -> None:
    """Append observed counts of (table, run date) to ``<root>/_control/quality_audit``, one row per rule."""
    rows = []
    for table, run_date, seen in told:
        counts = dict(seen.get)
        total = counts.pop("rows_checked")
        rows += [(table, run_date, rule, total, failed or 0) for rule, failed in counts.items()]
    (spark.createDataFrame(rows, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_control/quality_audit"))


def ri_orphans(child: DataFrame, parent: DataFrame, child_key: str,
               parent_key: str | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row (NULL keys excluded)."""
    return ri_orphans_all([("check", child, child_key, parent, parent_key or child_key)])["check"]


def ri_orphans_all(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> dict[str, DataFrame]:
    """Orphans of several checks (name, child, child key, parent, parent key).

    Integer keys: bitmaps of child and parent keys meet first, and only rows in
    buckets with a foreign bit go on to the anti join (``operators.bitmaps``).
    Other keys, and keys too scattered for bitmaps: a left-anti join against the
    parent's distinct keys.
    """
    children = [(name, child, ck) for name, child, ck, _, _ in checks]
    parents = [(name, parent, pk) for name, _, _, parent, pk in checks]
    mapped = bitmaps.dense(children) & bitmaps.dense(parents)
    out, counts, buckets = {}, {}, None
    if mapped:
        buckets = materialize(bitmaps.foreign_buckets([s for s in children if s[0] in mapped],
                                                      [s for s in parents if s[0] in mapped]), "foreign-buckets")
        counts = bitmaps.counted(buckets)
    for (name, child, ck), (_, parent, pk) in zip(children, parents):
        if name in mapped:
            child, parent = (bitmaps.rows_of(side, buckets, counts) for side in ((name, child, ck), (name, parent, pk)))
            if child is None:
                out[name] = dict((n, df) for n, df, _ in children)[name].filter(F.lit(False))
                continue
        keys = parent.select(F.col(pk).alias("_pk")).distinct()
        out[name] = child.filter(F.col(ck).isNotNull()).join(keys, F.col(ck) == F.col("_pk"), "left_anti")
    return out


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; a NULL key is a key like others."""
    return key_uniqueness_all([("check", df, keys)])["check"]


def key_uniqueness_all(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> dict[str, DataFrame]:
    """Repeated keys of several tables (name, table, key columns).

    Single integer keys: only rows in buckets whose bitmap has fewer bits than
    rows are counted key by key (``operators.bitmaps``). Other keys: all rows are.
    """
    single = [(name, df, keys[0]) for name, df, keys in checks if len(keys) == 1]
    mapped = bitmaps.dense(single)
    counts, buckets = {}, None
    if mapped:
        buckets = materialize(bitmaps.repeated_buckets([s for s in single if s[0] in mapped]), "repeated-buckets")
        counts = bitmaps.counted(buckets)
    heavy = _heavy_groups(checks)
    out = {}
    for name, df, keys in checks:
        rows = df
        if name in mapped:
            missing = df.filter(F.col(keys[0]).isNull())
            found = bitmaps.rows_of((name, df, keys[0]), buckets, counts)
            rows = missing if found is None else found.unionByName(missing)
        out[name] = _repeated(rows.select(*keys), keys, heavy.get(name, []))
    return out


KEY_GROUPS = 1024


def _key_group(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))


def _heavy_groups(checks: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> dict[str, list[int]]:
    """Of the ``KEY_GROUPS`` groups of each table's keys those with over four times their share of rows (one pass over the keys)."""
    groups = reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("name"), _key_group(keys).alias("at")) for name, df, keys in checks])
    sizes = {}
    for r in groups.groupBy("name", "at").count().collect():  # at most KEY_GROUPS rows per table
        sizes.setdefault(r["name"], {})[r["at"]] = r["count"]
    return {name: [g for g, n in of.items() if n > 4 * sum(of.values()) / KEY_GROUPS + 1000] for name, of in sizes.items()}


def _repeated(rows: DataFrame, keys: Sequence[str], heavy: list[int]) -> DataFrame:
    """Keys of ``rows`` that occur more than once, with their count.

    Most keys occur once, so a partial aggregation would hold nearly every key of
    a split in memory and send them all on: keys are exchanged as they are, and
    counted in sorted order. Rows of the ``heavy`` groups, where a hot key is, do
    aggregate before the exchange.
    """
    apart = _key_group(keys).isin(heavy)
    run = Window.partitionBy(*keys).orderBy(*keys)
    n = F.count(F.lit(1)).over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = (rows.filter(~apart) if heavy else rows).select(*keys, n.cast("bigint").alias("n_rows"), F.row_number().over(run).alias("_place"))
    out = out.filter((F.col("n_rows") > 1) & (F.col("_place") == 1)).drop("_place")
    if heavy:
        hot = rows.filter(apart).groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
        out = out.unionByName(hot.filter(F.col("n_rows") > 1))
    return out


def content_duplicates(df: DataFrame, id_col: str, attrs: Sequence[str]) -> DataFrame:
    """Groups of different ids whose normalised attributes are identical.

    Attributes are compared after trim + lower; one row per group with the
    smallest id, the number of ids and the group's distinct-id count.
    """
    norm = [F.lower(F.trim(F.col(a).cast("string"))).alias(a) for a in attrs]
    g = df.select(F.col(id_col), *norm).groupBy(*attrs).agg(
        F.min(id_col).alias("keep_id"),
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.countDistinct(id_col).cast("bigint").alias("n_ids"),
    )
    return g.filter(F.col("n_ids") > 1)


# DDL defaults and NOT NULL columns of the source tables (fixed values).
NOT_NULL = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id", "customer_id", "order_date"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
    "inventory": ("inventory_id", "product_id"),
}
SOURCE_DEFAULTS = {
    "customers": {"loyalty_tier": "BRONZE"},
    "orders": {"order_status": "PLACED"},
    "order_items": {"discount_pct": 0},
    "inventory": {"quantity_on_hand": 0, "reorder_level": 10},
}


def not_null_rules(table: str) -> dict[str, str]:
    """Expectations of one source table: its NOT NULL columns are present."""
    return {f"{table}.{c}": f"{c} IS NOT NULL" for c in NOT_NULL[table]}


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by the column defaults (only columns present in ``df``)."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    if not present:
        return df
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in present.items()})


def content_duplicate_map(df: DataFrame, id_col: str, attrs: Sequence[str]) -> DataFrame:
    """(id, keep_id) for every id whose normalised content repeats under a
    smaller id -- the mapping that merges re-inserted copies.

    Ids and smallest ids meet in one exchange by a hash of the normalised
    attributes (the attributes are compared too); no id list is collected per
    group, so a group holding a third of all rows is a skewed join side AQE can
    split.
    """
    norm = df.select(F.col(id_col), F.struct(*[F.lower(F.trim(F.col(a).cast("string"))).alias(a)
                                               for a in attrs]).alias("_attrs"))
    norm = norm.select(id_col, F.xxhash64("_attrs").alias("_hash"), "_attrs").distinct()
    groups = norm.groupBy(F.col("_hash").alias("_h"), F.col("_attrs").alias("_a")).agg(
        F.min(id_col).alias("keep_id"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return (norm.join(groups, (F.col("_hash") == F.col("_h")) & F.col("_attrs").eqNullSafe(F.col("_a")))
                .filter(F.col(id_col) != F.col("keep_id"))
                .select(F.col(id_col), F.col("keep_id"))
                .distinct())
