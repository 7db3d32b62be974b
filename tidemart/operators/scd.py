"""Slowly changing dimensions (type 2 merge, backfill, change feed; type 1).

Merge plan (``compute_scd2_snapshot``):

* history rows (``is_current`` false) are passed through untouched;
* current rows are full-outer joined with the hashed source **once**, on the
  business key, with the source columns renamed (``s__*``) so repeated merges
  never clash on attribute ids;
* every joined row is classified (keep / expire+new / new / delete) and
  ``inline``-exploded into the 0..2 rows it produces -- one join, one shuffle
  per side, instead of five filtered copies of the join;
* new versions get dense surrogate keys from ``dense_keys`` (fixed ranges,
  no single-partition window), offset by the dimension's current maximum.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType

from tidemart.config import (
    CURRENT,
    CUSTOMER_SCD,
    END,
    FAR_FUTURE_DATE,
    ROW_HASH,
    START,
    ScdSpec,
)
from tidemart.functions import row_hash
from tidemart.operators.clean import dedup_latest
from tidemart.operators.keys import dense_keys, with_neighbors
from tidemart.session import materialize as _materialize
from tidemart.sources.lake import from_footers

_SRC = "s__"


def add_row_hash(df: DataFrame, tracked_cols: Sequence[str], strict: bool = False,
                 out_col: str = ROW_HASH) -> DataFrame:
    """Append the change-detection hash over ``tracked_cols``."""
    return df.withColumn(out_col, row_hash(tracked_cols, strict))


def dim_schema(source_schema: StructType, spec: ScdSpec = CUSTOMER_SCD) -> StructType:
    """Declared schema of a type-2 dimension built from ``source_schema``."""
    kinds = {f.name: f.dataType for f in source_schema.fields} | {
        ROW_HASH: StringType(), spec.sk_col: LongType(), START: DateType(), END: DateType(), CURRENT: BooleanType()}
    return StructType([StructField(c, kinds[c]) for c in _version_cols([f.name for f in source_schema.fields], spec)])


def as_declared(dim: DataFrame, schema: StructType) -> DataFrame:
    """The dimension in its declared column order and types."""
    return dim.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _spec(business_key: str | None, tracked_cols: Sequence[str] | None,
          spec: ScdSpec | None) -> ScdSpec:
    spec = spec or CUSTOMER_SCD
    kw = {}
    if business_key is not None and business_key != spec.business_key:
        kw["business_key"] = business_key
    if tracked_cols is not None:
        kw["tracked"] = tuple(tracked_cols)
    if kw:
        spec = ScdSpec(**{**spec.__dict__, **kw})
    return spec


def _version_cols(source_cols: Sequence[str], spec: ScdSpec) -> list[str]:
    data = [c for c in source_cols if c != spec.deleted_col]
    return data + [ROW_HASH, spec.sk_col, START, END, CURRENT]


def initialize_dimension(source_df: DataFrame, tracked_cols: Sequence[str] | None = None,
                         as_of_date: date | None = None, business_key: str | None = None,
                         spec: ScdSpec | None = None, num_buckets: int | None = None) -> DataFrame:
    """Bootstrap: every source row is a current version from ``as_of_date``.

    Surrogate keys are 1..n in business-key order.
    """
    spec = _spec(business_key, tracked_cols, spec)
    src = source_df
    if spec.deleted_col and spec.deleted_col in src.columns:
        src = src.filter(~F.coalesce(F.col(spec.deleted_col), F.lit(False))).drop(spec.deleted_col)
    hashed = _materialize(add_row_hash(src, spec.tracked, spec.strict_hash), "scd2-first")
    keyed = dense_keys(hashed, [spec.business_key], spec.sk_col, 0, num_buckets)
    out = keyed.withColumns({
        START: F.lit(as_of_date).cast("date"),
        END: F.lit(FAR_FUTURE_DATE).cast("date"),
        CURRENT: F.lit(True),
    })
    return out.select(*_version_cols(src.columns, spec))


def dim_maxima(dim: DataFrame, spec: ScdSpec) -> DataFrame:
    """One row (max_sk, max_start)."""
    return dim.agg(F.max(spec.sk_col).alias("max_sk"), F.max(START).alias("max_start"))


def dim_stats(existing_dim: DataFrame, spec: ScdSpec, path: str | None = None) -> tuple[int | None, date | None]:
    """(max surrogate key, latest start date) in one small aggregation job.

    ``path``: where the dimension's files lie, when it is a published snapshot;
    then the footers' statistics answer (``lake.from_footers``). Files without
    such statistics are scanned.
    """
    if path is not None:
        try:
            row = dim_maxima(from_footers(existing_dim.sparkSession, path), spec).first()
            return row["max_sk"], row["max_start"]
        except (PySparkException, Py4JError):  # no statistics in a file: Spark refuses to answer
            pass
    row = dim_maxima(existing_dim, spec).first()
    return row["max_sk"], row["max_start"]


def _classified(existing_dim: DataFrame, source_df: DataFrame, as_of_date: date,
                spec: ScdSpec) -> tuple[DataFrame, DataFrame, list[str]]:
    """Join current versions with the source; return (history, exploded, cols).

    ``exploded`` has the dimension columns plus ``_action``: keep (untouched),
    update (same key, other values: refreshed or replaced in place), expire, or
    new (still without a key).
    """
    key = spec.business_key
    src_cols = [c for c in source_df.columns if c != spec.deleted_col]
    out_cols = _version_cols(src_cols, spec)
    data_cols = [c for c in src_cols]
    # Schema evolution: a column new in the source is NULL in older versions.
    src_types = dict(source_df.dtypes)
    dim = existing_dim.select(*[F.col(c) if c in existing_dim.columns
                                else F.lit(None).cast(src_types[c]).alias(c) for c in out_cols])

    src = add_row_hash(source_df, spec.tracked, spec.strict_hash)
    src = src.select(*[F.col(c).alias(_SRC + c) for c in src.columns])

    cur = dim.filter(F.col(CURRENT) == True)  # noqa: E712
    hist = dim.filter(~F.coalesce(F.col(CURRENT), F.lit(False)))

    j = cur.join(src, cur[key] == src[_SRC + key], "full_outer")
    d_hash, s_hash = F.col(ROW_HASH), F.col(_SRC + ROW_HASH)
    deleted = (F.coalesce(F.col(_SRC + spec.deleted_col), F.lit(False))
               if spec.deleted_col else F.lit(False))
    action = (F.when(d_hash.isNull() & deleted, F.lit("skip"))
               .when(d_hash.isNull(), F.lit("insert"))
               .when(s_hash.isNull(), F.lit("keep"))
               .when(deleted, F.lit("delete"))
               .when(d_hash == s_hash, F.lit("keep"))
               .when((F.col(START) == F.lit(as_of_date).cast("date")) & F.lit(spec.same_day == "replace"),
                     F.lit("replace"))
               .otherwise(F.lit("change")))
    j = j.withColumn("_act", action)

    expire_end = F.lit(as_of_date - timedelta(days=1)).cast("date")
    refresh = spec.passthrough_mode == "refresh"

    def old_field(c: str):
        if c == END:
            return F.when(F.col("_act").isin("change", "delete"), expire_end).otherwise(F.col(END))
        if c == CURRENT:
            return F.when(F.col("_act").isin("change", "delete"), F.lit(False)).otherwise(F.col(CURRENT))
        return F.col(c)

    old_vals = []
    for c in out_cols:
        if refresh and c in spec.passthrough:
            v = F.when((F.col("_act") == "keep") & s_hash.isNotNull(), F.col(_SRC + c)).otherwise(F.col(c))
        else:
            v = old_field(c)
        old_vals.append(v.alias(c))
    replace = F.col("_act") == "replace"
    new_vals = []
    for c in out_cols:
        if c in data_cols or c == ROW_HASH:
            v = F.col(_SRC + c)
        elif c == spec.sk_col:
            v = F.when(replace, F.col(spec.sk_col)).otherwise(F.lit(None).cast("bigint"))
        elif c == START:
            v = F.when(replace, F.col(START)).otherwise(F.lit(as_of_date).cast("date"))
        elif c == END:
            v = F.lit(FAR_FUTURE_DATE).cast("date")
        else:  # CURRENT
            v = F.lit(True)
        new_vals.append(v.alias(c))

    refreshed = F.lit(False)
    if refresh:
        for c in spec.passthrough:
            if c in out_cols:
                refreshed = refreshed | ~F.col(c).eqNullSafe(F.col(_SRC + c))
        refreshed = refreshed & s_hash.isNotNull()
    old_tag = (F.when((F.col("_act") == "keep") & refreshed, F.lit("update"))
                .when(F.col("_act") == "keep", F.lit("keep")).otherwise(F.lit("expire")))
    old_row = F.when(F.col("_act").isin("keep", "change", "delete"),
                     F.struct(*old_vals, old_tag.alias("_action")))
    new_row = F.when(F.col("_act").isin("change", "insert", "replace"),
                     F.struct(*new_vals, F.when(replace, F.lit("update")).otherwise(F.lit("new")).alias("_action")))
    exploded = j.select(F.inline(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())))
    return hist, exploded, out_cols


def _check_date(as_of_date: date, max_start: date | None) -> None:
    if max_start is not None and as_of_date < max_start:
        raise ValueError(f"as_of_date {as_of_date} is before the newest version start {max_start}")


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key occurs twice (one partial-aggregated pass)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in source: {dup[0].asDict()}")


def compute_scd2_snapshot(existing_dim: DataFrame | None, source_df: DataFrame,
                          as_of_date: date, business_key: str | None = None,
                          tracked_cols: Sequence[str] | None = None,
                          spec: ScdSpec | None = None,
                          num_buckets: int | None = None,
                          materialize: bool = True,
                          validate_source: bool = False,
                          stats: tuple[int | None, date | None] | None = None) -> DataFrame:
    """Full new dimension after applying one source snapshot at ``as_of_date``.

    * unchanged current rows: carried (start date kept);
    * tracked change: old version ends ``as_of_date - 1`` and is no longer
      current, a new current version starts ``as_of_date`` with a new key;
    * new business key: inserted as current;
    * key missing from the source: kept current (no implicit delete);
    * ``spec.deleted_col`` true: current version expires, no new version;
    * expired history: untouched.

    Raises if ``as_of_date`` is before the newest version start (that would
    create inverted intervals). The source must have one row per key.

    With ``materialize`` (default) the classified join result is written once
    to the shared folder, so the join runs once although both the carried
    rows and the key assignment of the new rows read it. ``stats`` (see
    ``dim_stats``) spares a job when the caller has them.
    """
    spec = _spec(business_key, tracked_cols, spec)
    if validate_source:
        assert_unique_keys(source_df, [spec.business_key])
    if existing_dim is None:
        return initialize_dimension(source_df, spec=spec, as_of_date=as_of_date,
                                    num_buckets=num_buckets)
    max_sk, max_start = stats or dim_stats(existing_dim, spec)
    if max_sk is None:
        return initialize_dimension(source_df, spec=spec, as_of_date=as_of_date,
                                    num_buckets=num_buckets)
    _check_date(as_of_date, max_start)
    hist, exploded, cols = _classified(existing_dim, source_df, as_of_date, spec)
    if materialize:
        exploded = _materialize(exploded, "scd2-classified")
    kept = exploded.filter(F.col("_action") != "new").select(*cols)
    new = dense_keys(exploded.filter(F.col("_action") == "new").select(*cols).drop(spec.sk_col),
                     [spec.business_key], spec.sk_col, int(max_sk), num_buckets).select(*cols)
    return hist.unionByName(kept).unionByName(new)


def scd2_changes(existing_dim: DataFrame, source_df: DataFrame, as_of_date: date,
                 spec: ScdSpec | None = None, num_buckets: int | None = None,
                 validate_source: bool = False,
                 stats: tuple[int | None, date | None] | None = None) -> DataFrame:
    """Only the rows a MERGE would write.

    ``existing_dim`` may be the current versions of the source's keys alone when
    ``stats`` (see ``dim_stats``) describes the whole dimension.

    Column ``_change`` is ``expire`` or ``update`` (replace the row with this
    surrogate key) or ``insert``; ``apply_scd2_changes`` with them gives exactly
    ``compute_scd2_snapshot``, for every spec.
    """
    spec = spec or CUSTOMER_SCD
    if validate_source:
        assert_unique_keys(source_df, [spec.business_key])
    max_sk, max_start = stats or dim_stats(existing_dim, spec)
    _check_date(as_of_date, max_start)
    _, exploded, cols = _classified(existing_dim, source_df, as_of_date, spec)
    exploded = _materialize(exploded, "scd2-changes")
    changed = exploded.filter(F.col("_action").isin("expire", "update")).select(
        *cols, F.col("_action").alias("_change"))
    new = dense_keys(exploded.filter(F.col("_action") == "new").select(*cols).drop(spec.sk_col),
                     [spec.business_key], spec.sk_col, int(max_sk or 0), num_buckets)
    return changed.unionByName(new.select(*cols, F.lit("insert").alias("_change")))


def apply_scd2_changes(existing_dim: DataFrame, changes: DataFrame, spec: ScdSpec | None = None) -> DataFrame:
    """The dimension after a change feed: rows whose key the feed carries are replaced, inserts added."""
    spec = spec or CUSTOMER_SCD
    replaced = changes.filter(F.col("_change") != "insert").select(F.col(spec.sk_col).alias("_replaced"))
    kept = existing_dim.join(replaced, F.col(spec.sk_col) == F.col("_replaced"), "left_anti")
    return kept.unionByName(changes.drop("_change"), allowMissingColumns=True)


def scd2_backfill(snapshots: DataFrame, snapshot_col: str, spec: ScdSpec | None = None,
                  num_buckets: int | None = None, method: str = "ordinal") -> DataFrame:
    """Build a type-2 dimension from many dated snapshots in one pass.

    ``snapshots`` holds one row per (key, snapshot date). A version starts
    where the tracked hash differs from the key's previous *present*
    snapshot, or where a deleted key returns; it ends the day before the next
    version or deletion. Keys missing from a snapshot keep their version open,
    exactly as repeated merges do, and surrogate keys are numbered by (start
    date, key) -- the same numbers repeated merges hand out. With
    ``passthrough_mode="refresh"`` a version carries the untracked values of the
    last snapshot it was seen in.

    ``method="ordinal"`` (default) finds previous/next rows in ranges of the
    (key, date) order (``with_neighbors``), so a key holding a large share of
    all rows is spread over every task; ``method="window"`` uses
    ``lag``/``lead`` windows per key (one shuffle fewer, one task per key).
    """
    spec = spec or CUSTOMER_SCD
    key = spec.business_key
    if method not in ("ordinal", "window"):
        raise ValueError(f"method must be ordinal|window, got {method!r}")

    def neighbors(df: DataFrame, prev: Sequence[str], following: Sequence[str]) -> DataFrame:
        if method == "ordinal":
            return with_neighbors(_materialize(df, "scd2-points"), key, [snapshot_col], prev_cols=prev, next_cols=following,
                                  num_buckets=num_buckets)
        w = Window.partitionBy(key).orderBy(snapshot_col)
        return df.withColumns({f"_prev_{c}": F.lag(c).over(w) for c in prev}
                              | {f"_next_{c}": F.lead(c).over(w) for c in following})

    data_cols = [c for c in snapshots.columns if c not in (snapshot_col, spec.deleted_col)]
    hashed = add_row_hash(snapshots, spec.tracked, spec.strict_hash)
    gone = F.coalesce(F.col(spec.deleted_col), F.lit(False)) if spec.deleted_col in snapshots.columns else F.lit(False)
    # state of a key in a snapshot: its hash, or empty when deleted
    states = hashed.withColumn("_state", F.when(gone, F.lit("")).otherwise(F.col(ROW_HASH)))
    refresh = [c for c in spec.passthrough if c in data_cols] if spec.passthrough_mode == "refresh" else []
    seen = neighbors(states, ["_state"], ["_state"] if refresh else [])
    before = F.coalesce(F.col("_prev__state"), F.lit(""))
    starts = F.col("_state") != before
    if refresh:  # the last row of a version brings the newest untracked values
        last = F.col("_next__state").isNull() | (F.col("_next__state") != F.col("_state"))
        edges = (seen.withColumn("_starts", starts).filter(starts | (last & (F.col("_state") != "")))
                     .drop("_prev__state", "_next__state"))
        linked = neighbors(edges, [], ["_starts", *refresh])
        points = linked.filter("_starts").withColumns({
            c: F.when(F.col("_next__starts") == F.lit(False), F.col(f"_next_{c}")).otherwise(F.col(c)) for c in refresh})
        points = points.select(*data_cols, ROW_HASH, snapshot_col, "_state")
    else:
        points = seen.filter(starts).drop("_prev__state")
    ended = neighbors(points, [], [snapshot_col]).filter(F.col("_state") != "")
    nxt = F.col("_next_" + snapshot_col)
    versions = ended.select(
        *data_cols, ROW_HASH,
        F.col(snapshot_col).cast("date").alias(START),
        F.coalesce(F.date_sub(nxt, 1), F.lit(FAR_FUTURE_DATE).cast("date")).alias(END),
        nxt.isNull().alias(CURRENT),
    )
    keyed = dense_keys(_materialize(versions, "scd2-versions"), [START, key], spec.sk_col, 0, num_buckets)
    return keyed.select(*_version_cols(data_cols, spec))


def scd1_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Type-1 dimension: one row per key carrying the newest values."""
    return dedup_latest(df, keys, order_by, tie_breakers)
