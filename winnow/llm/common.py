"""What the operators share: tables, the shared work folder, worker imports."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship_package  # noqa: F401

BROADCAST_BYTES = 64 << 20  # no operator broadcasts more than this, and only after counting


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends there, so a lost executor costs no earlier work. The folder is
    deleted when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(rows, text: str, size: int = 8 << 20) -> Iterator:
    """Slices of a pandas frame of about ``size`` characters of text (one row at
    least), so that vector work on a batch stays within a fixed memory."""
    lengths = rows[text].map(lambda t: len(t) if t else 0).to_numpy()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield rows.iloc[start:i]
            start, total = i, 0
        total += int(n)
    if start < len(rows):
        yield rows.iloc[start:]


def batch_slices(batches, text: str, size: int = 8 << 20) -> Iterator:
    """Slices of Arrow record batches of about ``size`` bytes of text (one row
    at least); columns pass through unchanged."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fits_broadcast(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast when the counted size is within the bound; else the
    planner joins by shuffle."""
    return F.broadcast(df) if fits_broadcast(rows, row_bytes) else df
