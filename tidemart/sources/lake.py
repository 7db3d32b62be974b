"""File layers: dated raw extracts, append-only bronze, published snapshots.

Layout below one root (any Hadoop FS URI)::

    raw/<table>/dt=<run date>/batch=<run id>/part-*.parquet
    bronze/<table>/_load_date=<run date>/part-*.parquet
    snapshots/<table>/v=<snapshot id>/part-*.parquet
    _control/watermarks, _control/run_audit

    _control/schemas/<layer>-<table>/v=<n>/

Raw keeps every extraction run of a day (one ``batch`` directory per run),
so a second run on the same day no longer overwrites the first delta.
Bronze is keyed by load date and written with dynamic partition overwrite:
loading a date again replaces that date instead of appending it twice.

The schema of each raw and bronze table is stored when it is written, so reads
never open the footers of all files to find it out. A column may get a wider
type on a later day; earlier files are promoted when they are read.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
)

from tidemart.session import path_exists

LOAD_DATE = "_load_date"
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
"""How the layers' files are written: once for each layer and day, so their size counts more than the time to pack them."""


def stored_schema(spark: SparkSession, root: str, layer: str, table: str) -> StructType | None:
    """Schema recorded for a table (all columns it ever had); None before its first write."""
    path = f"{root}/_control/schemas/{layer}-{table}"
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).collect()  # one small row for each change of the schema
    newest = max(_version(r) for r in rows)
    out = None  # two loads at once may both have written the newest version
    for value in sorted(r["value"] for r in rows if _version(r) == newest):
        out = merge_schema(out, StructType.fromJson(json.loads(value)), f"{layer}.{table}")
    return out


def _version(row) -> int:
    return int(str(row["v"]).split("-")[0])


def record_schema(spark: SparkSession, root: str, layer: str, table: str, schema: StructType) -> StructType:
    """Adds new columns and wider types of ``schema`` to the table's recorded schema; other changed types raise.

    Every write has a folder of its own, so loads at once never meet in one.
    """
    old = stored_schema(spark, root, layer, table)
    merged = merge_schema(old, schema, f"{layer}.{table}")
    if old is None or merged != old:
        path = f"{root}/_control/schemas/{layer}-{table}"
        version = 0 if old is None else max(_version(r) for r in spark.read.text(path).select("v").distinct().collect()) + 1
        (spark.createDataFrame([(merged.json(),)], "value string").coalesce(1)
              .write.text(f"{path}/v={version}-{uuid.uuid4().hex[:8]}"))
    return merged


def merge_schema(old: StructType | None, new: StructType, what: str) -> StructType:
    """Columns of ``old``, then those only ``new`` has; all nullable.

    A column whose type differs gets the wider of both types when that holds
    every value of the other (``wider``); any other change raises.
    """
    fields = {f.name: f.dataType for f in (old or StructType()).fields}
    for f in new.fields:
        before = fields.setdefault(f.name, f.dataType)
        kind = wider(before, f.dataType)
        if kind is None:
            raise ValueError(f"{what}: column {f.name} changes from {before.simpleString()} to {f.dataType.simpleString()}")
        fields[f.name] = kind
    out = StructType()
    for name, kind in fields.items():
        out.add(name, kind, True)
    return out


_INTEGERS = [ByteType(), ShortType(), IntegerType(), LongType()]
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds all values of both without loss; None where there is none.

    Integers widen to longer integers, decimals to more digits on either side,
    integers to decimals with as many digits before the point, float to double,
    and integers of at most 32 bits to double.
    """
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if x in _INTEGERS and y in _INTEGERS and _INTEGERS.index(x) < _INTEGERS.index(y):
            return y
        if isinstance(x, FloatType) and isinstance(y, DoubleType):
            return y
        if x in _INTEGERS[:3] and isinstance(y, DoubleType):
            return y
        if x in _INTEGERS and isinstance(y, DecimalType):
            digits = max(_DIGITS[x.simpleString()], y.precision - y.scale)
            return DecimalType(digits + y.scale, y.scale) if digits + y.scale <= 38 else None
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return None


def balanced(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` in write partitions of even size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).

    The REBALANCE hint leaves it to adaptive execution to merge small partitions
    and to split hot ones, by ``cols`` where the write is partitioned by them.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols])


def write_raw(df: DataFrame, root: str, table: str, run_date: str, run_id: str | None = None) -> str:
    """Write one extraction run; returns its directory.

    Rows go from the source's splits to the files as they come, without an
    exchange: a scan has merged small files and cut large ones already.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    path = f"{root}/raw/{table}/dt={run_date}/batch={run_id}"
    record_schema(df.sparkSession, root, "raw", table, df.schema)
    df.write.mode("overwrite").options(**PACKED).parquet(path)
    return path


def read_raw(spark: SparkSession, root: str, table: str, run_date: str | None = None) -> DataFrame:
    """All runs of one date (or of all dates); adds ``dt`` and ``batch``.

    The date filter prunes directories instead of listing the whole table.
    """
    base = f"{root}/raw/{table}"
    schema = StructType(stored_schema(spark, root, "raw", table).fields).add("dt", "date").add("batch", "string")
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(base if run_date is None else f"{base}/dt={run_date}")


def load_raw_to_bronze(spark: SparkSession, root: str, table: str, run_date: str) -> None:
    """Bronze load of one run date: as received plus load metadata.

    Idempotent per date: runs that bronze has already stay as they lie and only
    later ones are added; where it has anything else (a run in part, or one that
    raw does not have), the date is written anew (dynamic partition overwrite).
    New source columns are accepted and old files read them as NULL (the stored
    schema has them all). The load is a copy by the scan's splits, without an
    exchange.
    """
    if not run_date:
        raise ValueError("run_date is required")
    raw = read_raw(spark, root, table, run_date).drop("dt", "batch").withColumn("_source_file", F.col("_metadata.file_path"))
    held = _held(spark, root, table, run_date, raw)
    if held:
        raw = raw.filter(~run_of().isin(held))
    out = raw.select(*[c for c in raw.columns if c != "_source_file"], F.current_timestamp().alias("_bronze_loaded_at"),
                     "_source_file", F.lit(run_date).cast("date").alias(LOAD_DATE))
    record_schema(spark, root, "bronze", table, out.schema)
    (out.write.mode("append" if held else "overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**PACKED).partitionBy(LOAD_DATE).parquet(f"{root}/bronze/{table}"))


def run_of() -> Column:
    """The extraction run that a bronze row comes from."""
    return F.coalesce(F.substring_index(F.substring_index("_source_file", "/batch=", -1), "/", 1), F.lit(""))


def _held(spark: SparkSession, root: str, table: str, run_date: str, raw: DataFrame) -> list[str]:
    """Runs of a date that bronze has as raw has them, by their files and the rows of each; none if it has others.

    Only the files' names are read, a number or two per run comes to the driver.
    """
    if not path_exists(spark, f"{root}/bronze/{table}/{LOAD_DATE}={run_date}"):
        return []
    runs = lambda df: {tuple(r) for r in df.groupBy(run_of()).agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("_source_file").cast("decimal(38,0)"))).collect()}
    bronze = read_bronze(spark, root, table).filter(F.col(LOAD_DATE) == F.lit(run_date).cast("date"))
    there, here = runs(raw), runs(bronze)
    return sorted(r[0] for r in here) if here <= there else []


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = stored_schema(spark, root, "bronze", table)
    if schema is None:
        raise FileNotFoundError(f"bronze table {table} has not been loaded")
    return spark.read.schema(schema).parquet(f"{root}/bronze/{table}")


def publish_snapshot(df: DataFrame, root: str, table: str, catalog_name: str | None = None,
                     snapshot_id: str | None = None, balance: bool = True) -> str:
    """Write a new immutable snapshot directory, then repoint the table to it.

    Readers of the previous snapshot are never disturbed (Parquet cannot be
    overwritten while it is being read); the switch is one catalog update. The
    directory is unique per attempt, so a failed or repeated run never meets its
    own leftovers. Snapshots are not bucketed: a join on the key stays an
    ordinary exchange that adaptive execution can split at a hot key, and the
    rows never depend on a partition count of the session. ``balance=False``
    writes ``df`` as it is dealt: for a join's result, whose partitions adaptive
    execution has merged and split already.
    """
    snapshot_id = snapshot_id or "s"
    path = f"{root}/snapshots/{table}/v={snapshot_id}-{uuid.uuid4().hex[:8]}"
    (balanced(df) if balance else df).write.mode("errorifexists").options(**PACKED).parquet(path)
    if catalog_name:
        repoint(df.sparkSession, root, catalog_name, path, df.schema)
    return path


def repoint(spark: SparkSession, root: str, catalog_name: str, path: str, schema: StructType) -> None:
    """Make ``path`` the table's data.

    Columns new to the table are added first (older files read them as NULL),
    columns it no longer has stay and read as NULL. A column with a wider type
    makes the table anew (its files stay); any other change of a type raises
    before anything is switched.
    """
    ensure_database(spark, root, catalog_name)
    if spark.catalog.tableExists(catalog_name):
        old = spark.table(catalog_name).schema
        schema = merge_schema(old, schema, catalog_name)
        if any(f.dataType != schema[f.name].dataType for f in old.fields):
            spark.sql(f"DROP TABLE {catalog_name}")
    if not spark.catalog.tableExists(catalog_name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {catalog_name} ({columns}) USING parquet LOCATION '{path}'")
        return
    new = [f for f in schema.fields if f.name not in old.fieldNames()]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {catalog_name} ADD COLUMNS ({columns})")
    spark.sql(f"ALTER TABLE {catalog_name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(catalog_name)


def table_location(spark: SparkSession, catalog_name: str) -> str | None:
    """Where the published snapshot lies; None when the table does not exist."""
    if not spark.catalog.tableExists(catalog_name):
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {catalog_name}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]


def delete_old(spark: SparkSession, folder: str, live: set[str], min_age_hours: float) -> list[str]:
    """Delete the folders below ``folder`` that are not ``live`` and were last changed before the minimum age.

    The age keeps what readers of an earlier state may still read and what a
    running attempt has just written. Only names and times are listed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    before = (time.time() - min_age_hours * 3600) * 1000
    kept = {spark._jvm.org.apache.hadoop.fs.Path(x).toUri().getPath() for x in live}
    gone = []
    for f in fs.listStatus(path):
        if f.isDirectory() and f.getModificationTime() < before and f.getPath().toUri().getPath() not in kept:
            fs.delete(f.getPath(), True)
            gone.append(f.getPath().getName())
    return sorted(gone)


def clean_snapshots(spark: SparkSession, root: str, table: str, catalog_name: str, min_age_hours: float) -> list[str]:
    """Delete published snapshots that a table no longer points at; returns their folders' names."""
    live = table_location(spark, catalog_name)
    return [] if live is None else delete_old(spark, f"{root}/snapshots/{table}", {live}, min_age_hours)


def from_footers(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose min, max and count need no column scan.

    A side session (shared context, settings of its own) reads them through the
    v2 reader with aggregate pushdown: such aggregates over whole files are
    answered from the footers' statistics.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return side.read.parquet(path)


def ensure_database(spark: SparkSession, root: str, catalog_name: str) -> None:
    """Create the table's database below ``root`` (the shared folder), not in
    the session's default warehouse, which may be local to one machine."""
    if "." in catalog_name:
        db = catalog_name.split(".")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_catalog/{db}.db'")


def read_table(spark: SparkSession, catalog_name: str) -> DataFrame | None:
    """The published snapshot, or None when the table does not exist yet."""
    return spark.table(catalog_name) if spark.catalog.tableExists(catalog_name) else None
