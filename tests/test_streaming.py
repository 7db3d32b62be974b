import pathlib
import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from tidemart.session import path_exists, scratch_dir
import pytest

from tidemart.sources import parts
from tidemart.streaming import ingest
from tidemart.streaming.ingest import dedup_events, scd2_batch_writer

DDL = ("customer_id long, loyalty_tier string, address string, city string, state string, "
       "postal_code string, email string, first_name string, last_name string, country string, "
       "snapshot_date date")


def _snap(spark, tier, day):
    return spark.createDataFrame([(1, tier, "1 Main", "Austin", "TX", "78701", "x@y.com", "Jo", "Li", "USA", day)],
                                 DDL)


def test_retried_micro_batch_is_applied_once(spark):
    root = scratch_dir(spark, "t-stream")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer"
    apply = scd2_batch_writer(root, "dim_customer", name, "snapshot_date")
    apply(_snap(spark, "BRONZE", date(2026, 1, 1)), 0)
    apply(_snap(spark, "GOLD", date(2026, 2, 1)), 1)
    apply(_snap(spark, "GOLD", date(2026, 2, 1)), 1)  # retry of batch 1
    rows = spark.table(name).collect()
    assert len(rows) == 2 and sum(r["is_current"] for r in rows) == 1


def test_several_snapshot_dates_in_one_batch_apply_in_order(spark):
    root = scratch_dir(spark, "t-stream2")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer"
    apply = scd2_batch_writer(root, "dim_customer", name, "snapshot_date")
    batch = _snap(spark, "SILVER", date(2026, 2, 1)).unionByName(_snap(spark, "BRONZE", date(2026, 1, 1)))
    apply(batch, 0)
    rows = sorted(spark.table(name).collect(), key=lambda r: r["effective_start_date"])
    assert [r["loyalty_tier"] for r in rows] == ["BRONZE", "SILVER"]


def test_dedup_events_keeps_ntz_type(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "event_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = dedup_events(df, ["event_id"], "ts", "1 day")
    assert dict(out.dtypes)["ts"] == "timestamp_ntz"


def _versions(spark, name):
    return sorted((r["loyalty_tier"], r["effective_start_date"], r["is_current"], r["customer_sk"])
                  for r in spark.table(name).collect())


@pytest.mark.parametrize("where", ["before the log", "after the log", "after the publish"])
def test_a_batch_recovers_from_a_crash(spark, monkeypatch, where):
    root = scratch_dir(spark, "t-crash")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer"
    apply = scd2_batch_writer(root, "dim_customer", name, "snapshot_date")
    apply(_snap(spark, "BRONZE", date(2026, 1, 1)), 0)
    batch = _snap(spark, "GOLD", date(2026, 2, 1))

    def stop(*args, **kwargs):
        raise RuntimeError("crash")

    if where == "before the log":  # the new folder is written
        monkeypatch.setattr(parts, "record", stop)
    elif where == "after the log":  # the view still shows the old state
        monkeypatch.setattr(parts, "publish", stop)
    if where == "after the publish":
        apply(batch, 1)  # the stream's own checkpoint was lost after this
    else:
        with pytest.raises(RuntimeError, match="crash"):
            apply(batch, 1)
        monkeypatch.undo()
        assert _versions(spark, name) == [("BRONZE", date(2026, 1, 1), True, 1)]
    apply(batch, 1)
    apply(_snap(spark, "SILVER", date(2026, 3, 1)), 2)
    assert _versions(spark, name) == [("BRONZE", date(2026, 1, 1), False, 1), ("GOLD", date(2026, 2, 1), False, 2),
                                      ("SILVER", date(2026, 3, 1), True, 3)]


def test_a_batch_of_two_dates_goes_on_after_the_first(spark, monkeypatch):
    root = scratch_dir(spark, "t-two")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer"
    apply = scd2_batch_writer(root, "dim_customer", name, "snapshot_date")
    batch = _snap(spark, "BRONZE", date(2026, 1, 1)).unionByName(_snap(spark, "GOLD", date(2026, 2, 1)))
    whole, calls = parts.commit, []

    def once(*args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("crash")
        return whole(*args, **kwargs)

    monkeypatch.setattr(parts, "commit", once)
    with pytest.raises(RuntimeError, match="crash"):
        apply(batch, 0)
    monkeypatch.undo()
    apply(batch, 0)
    apply(batch, 0)
    assert _versions(spark, name) == [("BRONZE", date(2026, 1, 1), False, 1), ("GOLD", date(2026, 2, 1), True, 2)]
    assert not path_exists(spark, f"{root}/_control/dim_customer_late")


EVENTS = "event_id long, ts timestamp, v string"


def _land(spark, folder, n, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{folder}/b{n}")


def test_dedup_state_lies_in_rocksdb_survives_a_restart_and_is_bounded(spark):
    root = scratch_dir(spark, "t-rocks")
    day = lambda d, h=0: datetime(2026, 1, d, h)
    run = lambda: ingest.stream_dedup(spark, f"{root}/in/*", spark.createDataFrame([], EVENTS).schema, f"{root}/out",
                                      f"{root}/ckpt", ["event_id"], "ts", "2 days")
    _land(spark, f"{root}/in", 1, [(i, day(1, i % 24), "first") for i in range(100)])
    first = run()
    assert ingest.state_size(first)["keys"] == 100
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in before  # the session itself is as it was
    names = [f.name for f in pathlib.Path(f"{root}/ckpt/state").rglob("*")]
    assert any(n.endswith((".changelog", ".zip")) for n in names) and not any(n.endswith(".delta") for n in names)
    # a new run from the checkpoint: deliveries of before are known, new ones are not
    _land(spark, f"{root}/in", 2, [(i, day(1, i % 24), "again") for i in range(50)] + [(1000, day(2), "new")])
    run()
    rows = spark.read.parquet(f"{root}/out")
    assert rows.count() == 101 and rows.where("v = 'again'").count() == 0
    # once the watermark has passed, the old keys leave the state
    _land(spark, f"{root}/in", 3, [(2000, day(20), "late")])
    run()
    _land(spark, f"{root}/in", 4, [(2001, day(20), "late")])
    assert ingest.state_size(run())["keys"] <= 3


def test_late_snapshots_are_set_aside(spark):
    root = scratch_dir(spark, "t-late")
    name = f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer"
    apply = ingest.scd2_batch_writer(root, "dim_customer", name, "snapshot_date")
    apply(_snap(spark, "SILVER", date(2026, 2, 1)), 0)
    apply(_snap(spark, "BRONZE", date(2026, 1, 1)).unionByName(_snap(spark, "GOLD", date(2026, 3, 1))), 1)
    apply(_snap(spark, "BRONZE", date(2026, 1, 15)), 2)
    assert [v[0] for v in _versions(spark, name)] == ["GOLD", "SILVER"]
    late = spark.read.parquet(f"{root}/_control/dim_customer_late")
    assert sorted((r["snapshot_date"], r["batch"]) for r in late.collect()) == [(date(2026, 1, 1), 1), (date(2026, 1, 15), 2)]


def test_duplicate_source_keys_stop_the_stream(spark):
    root = scratch_dir(spark, "t-dup")
    apply = scd2_batch_writer(root, "dim_customer", f"tm_{uuid.uuid4().hex[:6]}_gold.dim_customer", "snapshot_date")
    day = date(2026, 1, 1)
    with pytest.raises(ValueError, match="duplicate key"):
        apply(_snap(spark, "GOLD", day).unionByName(_snap(spark, "SILVER", day)), 0)
