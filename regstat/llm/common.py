"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regstat.session import scratch_path

#: Rows whose crc32(doc_id as text) leaves this remainder are held out of every fit.
FOLDS, HELD_OUT = 5, 0
ARROW_ROWS = 2_000
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold at most ``ARROW_ROWS`` rows.

    Whole texts fill a batch's buffers in the executor's JVM and in its Python
    worker; the default of 10,000 rows takes hundreds of MB per task.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ROWS_PER_BATCH)) <= ARROW_ROWS:
        conf.set(ROWS_PER_BATCH, str(ARROW_ROWS))
    return df


def held_out(doc_id: Column) -> Column:
    """True for rows kept out of every fit; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_dir(path: str) -> str:
    """The file-system path of a shared folder that Spark names ``file:/…``; other stores are refused."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"record files need a folder mounted on every executor, not {path}")
    return url.path


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [b"" if t is None else t for t in col.to_pylist()]


def sub_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows; what Arrow has freed goes back to the system when a worker's task ends."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    pa.default_memory_pool().release_unused()


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
