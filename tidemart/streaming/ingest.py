"""Streaming ingestion: new raw files -> bronze, deduplicated events, SCD2.

All three run as incremental file-source streams with a checkpoint in the
shared folder, so every landed file is processed exactly once even when a
run is restarted; ``trigger(availableNow=True)`` drains what has landed and
stops, which makes the same code usable as a scheduled job or, with a
processing-time trigger, as an always-on stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemart.config import CUSTOMER_SCD, ScdSpec
from tidemart.plans import dimension
from tidemart.sources import parts


def read_landing(spark: SparkSession, landing_glob: str, schema: StructType) -> DataFrame:
    """Incremental scan of parquet files landing under ``landing_glob``."""
    return spark.readStream.schema(schema).parquet(landing_glob)


def with_load_metadata(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_bronze_loaded_at": F.current_timestamp(),
        "_source_file": F.col("_metadata.file_path"),
    })


def _run(writer, path: str | None = None, once: bool = True) -> StreamingQuery:
    if once:
        writer = writer.trigger(availableNow=True)
    q = writer.start(path) if path else writer.start()
    if once:
        q.awaitTermination()
    return q


def stream_bronze(spark: SparkSession, landing_glob: str, schema: StructType, bronze_path: str,
                  checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append newly landed raw files to bronze, exactly once per file."""
    out = with_load_metadata(read_landing(spark, landing_glob, schema))
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return _run(w, bronze_path, once)


STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB: on the executors' disks, not in their heap.

    Every batch uploads a changelog of the state it touched to the checkpoint
    (not a whole snapshot), so a lost executor's state is loaded again from the
    shared folder. A query takes these settings when it starts; a checkpoint
    keeps the ones it began with.
    """
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Keys held and removed, and memory used, by the query's state after its last batch."""
    operators = (query.lastProgress or {}).get("stateOperators", [])
    return {name: sum(o[field] for o in operators) for name, field in (
        ("keys", "numRowsTotal"), ("removed", "numRowsRemoved"), ("memory_bytes", "memoryUsedBytes"))}


def dedup_events(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop re-delivered events (same keys) arriving within ``delay``.

    The event-time column is used as a session-zone timestamp for the
    watermark (the input may be timestamp_ntz) and restored afterwards.
    The state holds one small row per key whose event time is not older than
    ``delay`` before the newest one: its bound is the keys of one delay.
    """
    ntz = dict(df.dtypes).get(event_time) == "timestamp_ntz"
    if ntz:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    out = df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
    if ntz:
        out = out.withColumn(event_time, F.col(event_time).cast("timestamp_ntz"))
    return out


def stream_dedup(spark: SparkSession, landing_glob: str, schema: StructType, out_path: str,
                 checkpoint: str, keys: Sequence[str], event_time: str, delay: str = "30 days",
                 once: bool = True) -> StreamingQuery:
    """Events without re-deliveries, appended to ``out_path``; the state of seen keys lies in RocksDB."""
    out = dedup_events(read_landing(spark, landing_glob, schema), keys, event_time, delay)
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    with state_on_disk(spark):
        return _run(w, out_path, once)


def scd2_batch_writer(root: str, table: str, view: str, snapshot_col: str,
                      spec: ScdSpec = CUSTOMER_SCD, n_parts: int = parts.N_PARTS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function applying each micro-batch as SCD2 snapshots.

    A micro-batch may carry several snapshot dates; they are applied in date
    order (only the distinct dates reach the driver), each as one commit of the
    dimension's parts (``plans.dimension``) called after batch and date. A
    commit is there or not, and what it replaced stays, so a batch run again
    after a crash at any point makes the commits that are missing: no change is
    applied twice and none is lost.

    Snapshots dated before the newest version cannot be merged any more. Their
    rows go to ``<root>/_control/<table>_late/batch=<id>`` and the stream goes on.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dates = sorted(r[0] for r in batch.select(snapshot_col).distinct().collect())
        state = parts.load(spark, root, table)
        done = state.names if state else ()
        newest = dimension.newest(state)[1]
        late = [d for d in dates if newest is not None and d < newest and f"{batch_id}:{d}" not in done]
        if late:
            (batch.filter(F.col(snapshot_col).isin(late)).write.mode("overwrite")
                  .parquet(f"{root}/_control/{table}_late/batch={batch_id}"))
        for d in dates:
            if d not in late:
                source = batch.filter(F.col(snapshot_col) == F.lit(d)).drop(snapshot_col)
                dimension.merge_dimension(spark, root, table, view, source, d, spec, name=f"{batch_id}:{d}",
                                          n_parts=n_parts)

    return apply


def stream_scd2(spark: SparkSession, landing_glob: str, schema: StructType, root: str, table: str,
                catalog_name: str, checkpoint: str, snapshot_col: str = "snapshot_date",
                spec: ScdSpec = CUSTOMER_SCD, once: bool = True, n_parts: int = parts.N_PARTS) -> StreamingQuery:
    src = read_landing(spark, landing_glob, schema)
    w = (src.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(scd2_batch_writer(root, table, catalog_name, snapshot_col, spec, n_parts)))
    return _run(w, None, once)
