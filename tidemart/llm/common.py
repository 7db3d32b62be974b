"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import scratch_dir, share_code

SLICE_BYTES = 4 << 20
"""Text that one numpy pass inside a task holds (a longer single text goes alone)."""


def write_and_read(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Durable lineage cut: zstd parquet in the shared folder, read back with its schema."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    share_code(df.sparkSession)
    return df.mapInArrow(fn, schema)


def lookup(rows: DataFrame, table: DataFrame, on: str, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``table`` (unique on ``key__``) where ``on`` equals ``key__``, null where nothing does.

    ``rows`` should be file-backed; it is read three times. Keys that hold more
    than 1 / ``share`` of the rows are looked up by broadcast - there are fewer
    than ``share`` of them at any size - and the others by an equi join in which
    no key has more than that part of the rows. Null keys meet no join.
    """
    total = rows.count()
    counts = rows.where(F.col(on).isNotNull()).groupBy(F.col(on).alias("hot__")).agg(F.count(F.lit(1)).alias("rows__"))
    hot = counts.where(F.col("rows__") * share > total).select("hot__")
    found = hot.join(table, F.col("hot__") == F.col("key__"), "left").drop("key__")
    flagged = rows.join(F.broadcast(found), F.col(on) == F.col("hot__"), "left")
    easy = flagged.where(F.col("hot__").isNotNull() | F.col(on).isNull()).drop("hot__")
    rest = rows.where(F.col(on).isNotNull()).join(F.broadcast(hot), F.col(on) == F.col("hot__"), "left_anti")
    rest = rest.join(table, F.col(on) == F.col("key__"), "left").drop("key__")
    return easy.unionByName(rest)


def task_count(df: DataFrame) -> int:
    """Partitions for keyed work: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """(id, hash of the text): rows that share both are repeated rows and share their result."""
    return [F.col(id_col).alias("k_id"), F.xxhash64(F.col(text_col)).alias("k_text")]


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds about ``limit`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if batch.nbytes <= limit:
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def map_texts(df: DataFrame, keep: list[str], text: str,
              fn: Callable[[list[bytes]], dict[str, list | np.ndarray]], out: T.StructType) -> DataFrame:
    """Adds columns that ``fn`` computes from lists of whole texts; ``keep`` passes through."""
    picked = df.select(*keep, F.col(text).cast("string").alias("t__"))
    schema = T.StructType([f for f in picked.schema.fields if f.name != "t__"] + out.fields)
    types = {f.name: _arrow(f.dataType) for f in out.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t__"):
            made = fn(utf8(b.column("t__")))
            arrays = [b.column(c) for c in keep] + [pa.array(made[c], type=t) for c, t in types.items()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *types])

    return arrow_map(picked, run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
