import pathlib
import shutil
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tidemart.config import TableSpec
from tidemart.session import scratch_dir
from tidemart.sources import extract, lake

SCHEMA = "id long, v string, updated_at timestamp_ntz"


def test_incremental_extract_moves_watermark(spark):
    root = scratch_dir(spark, "t-inc")
    spec = TableSpec("t", "incremental", "updated_at")
    src1 = spark.createDataFrame([(1, "a", datetime(2026, 1, 1)), (2, "b", datetime(2026, 1, 2))], SCHEMA)
    r1 = extract.extract_table(src1, spec, root, "2026-01-02", "r1")
    assert (r1.rows, r1.watermark) == (2, datetime(2026, 1, 2))
    src2 = src1.unionByName(spark.createDataFrame([(3, "c", datetime(2026, 1, 3))], SCHEMA))
    r2 = extract.extract_table(src2, spec, root, "2026-01-03", "r2")
    assert r2.rows == 1
    r3 = extract.extract_table(src2, spec, root, "2026-01-03", "r3")  # second run same day, nothing new
    assert r3.rows == 0
    assert extract.last_watermark(spark, root, "t") == ("2026-01-03 00:00:00", "timestamp_ntz")
    # the empty second run of 2026-01-03 did not overwrite the first run's row
    assert [r["id"] for r in lake.read_raw(spark, root, "t", "2026-01-03").collect()] == [3]


def test_bronze_load_is_idempotent_and_merges_schema(spark):
    root = scratch_dir(spark, "t-bronze")
    a = spark.createDataFrame([(1, "a", datetime(2026, 1, 1))], SCHEMA)
    lake.write_raw(a, root, "t", "2026-01-01")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    b = a.withColumn("extra", F.lit("x"))
    lake.write_raw(b, root, "t", "2026-01-02")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-02")
    rows = lake.read_bronze(spark, root, "t").select("id", "extra", lake.LOAD_DATE).collect()
    assert len(rows) == 2 and sorted(str(r["extra"]) for r in rows) == ["None", "x"]


def test_bronze_keeps_the_runs_that_it_has(spark):
    # a date loaded again was written anew with all its runs
    root = scratch_dir(spark, "t-runs")
    rows = lambda n: spark.createDataFrame([(i, "a", datetime(2026, 1, 1)) for i in range(n)], SCHEMA).coalesce(2)
    folder = pathlib.Path(root) / "bronze" / "t" / f"{lake.LOAD_DATE}=2026-01-01"
    files = lambda: {f.name for f in folder.glob("part-*.parquet")}
    ids = lambda: sorted(r["id"] for r in lake.read_bronze(spark, root, "t").collect())
    lake.write_raw(rows(5), root, "t", "2026-01-01", "r1")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    first = files()
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    assert files() == first
    lake.write_raw(rows(3).withColumn("extra", F.lit("x")), root, "t", "2026-01-01", "r2")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    second = files()
    assert first < second and ids() == sorted([*range(5), *range(3)])
    assert lake.read_bronze(spark, root, "t").where("extra = 'x' and _source_file like '%batch=r2%'").count() == 3
    # a load that broke off, a run that raw has in other files or has no more: the date is written anew
    next(folder.glob(sorted(second - first)[0])).unlink()
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    assert not second & files() and ids() == sorted([*range(5), *range(3)])
    lake.write_raw(rows(4), root, "t", "2026-01-01", "r1")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    assert ids() == sorted([*range(4), *range(3)])
    shutil.rmtree(f"{root}/raw/t/dt=2026-01-01/batch=r2")
    lake.load_raw_to_bronze(spark, root, "t", "2026-01-01")
    assert ids() == [*range(4)]


def test_snapshot_publish_repoints_table(spark):
    root = scratch_dir(spark, "t-snap")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.t"
    lake.publish_snapshot(spark.range(3), root, "t", name, "1")
    lake.publish_snapshot(spark.range(5), root, "t", name, "2")
    assert spark.table(name).count() == 5


def test_ntz_watermark_ignores_session_time_zone(spark):
    root = scratch_dir(spark, "t-tz")
    spec = TableSpec("t", "incremental", "updated_at")
    src = spark.createDataFrame([(1, "a", datetime(2026, 1, 1, 10)), (2, "b", datetime(2026, 1, 1, 12))], SCHEMA)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        extract.extract_table(src.filter("id = 1"), spec, root, "2026-01-01", "r1")
        assert extract.extract_table(src, spec, root, "2026-01-02", "r2").rows == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_integer_watermark_and_ties(spark):
    root = scratch_dir(spark, "t-int")
    spec = TableSpec("t", "incremental", "id")
    rows = [(9, "a", None), (10, "b", None), (11, "c", None)]
    src = spark.createDataFrame(rows, SCHEMA)
    assert extract.extract_table(src.filter("id < 11"), spec, root, "2026-01-01", "r1").rows == 2
    assert extract.last_watermark(spark, root, "t") == ("10", "bigint")  # 10 > 9, not as text
    assert extract.extract_table(src, spec, root, "2026-01-02", "r2").rows == 1
    again = TableSpec("t", "incremental", "id", ("id",), inclusive=True)
    late = src.unionByName(spark.createDataFrame([(11, "late", None)], SCHEMA))
    assert extract.extract_table(late, again, root, "2026-01-03", "r3").rows == 2  # the newest row again, and its late tie


def test_looking_up_a_watermark_writes_nothing(spark):
    from tidemart.session import path_exists
    root = scratch_dir(spark, "t-look")
    assert extract.last_watermark(spark, root, "t") is None
    assert not path_exists(spark, f"{root}/_control")


def test_a_lost_control_table_is_not_a_first_run(spark):
    import pytest
    root = scratch_dir(spark, "t-lost")
    lake.write_raw(spark.createDataFrame([(1, "a", datetime(2026, 1, 1))], SCHEMA), root, "t", "2026-01-01")
    with pytest.raises(RuntimeError, match="watermarks is missing"):
        extract.extract_table(spark.createDataFrame([], SCHEMA), TableSpec("t", "incremental", "updated_at"), root, "2026-01-02")
