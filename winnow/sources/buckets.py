"""Stored tables bucketed and sorted by a key digest.

Two tables with the same buckets join by that key without a shuffle of either, and
a table keeps its buckets when it is joined with a smaller one and written again.
For tables with one row a key (survivors, annotations, scores, key states): a bucket
can't be split, so rows of a hot key don't belong here.

The buckets are a property of the files' names; Spark takes it from a catalog. Here
the folder carries it itself (a one-row table ``_buckets`` beside the files, which
readers skip), and ``read`` enters the folder in the session's catalog under a name
of its own, so any later session can join without a shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "key_digest"
BUCKETS = 64


def _name() -> str:
    return f"winnow_{uuid.uuid4().hex}"


def write(df: DataFrame, path: str, key: str = KEY, buckets: int = BUCKETS, mode: str = "overwrite", placed: bool = False) -> None:
    """Store ``df`` at ``path``, one file a bucket, sorted by ``key``. ``placed``: the
    rows are already dealt as in the buckets (a join kept them), so nothing moves."""
    spark, path, name = df.sparkSession, path.rstrip("/"), _name()
    rows = df if placed else df.repartition(buckets, F.col(key))
    if mode == "append":  # a new external table over the folder, then rows into it
        spec = _spec(spark, path)
        if (spec["key"], spec["buckets"]) != (key, buckets):
            raise ValueError(f"{path} has {spec['buckets']} buckets by {spec['key']}")
        _enter(spark, path, name, spec)
    writer = rows.write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer if mode == "append" else writer.option("path", path)).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    if mode != "append":
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spec = spark.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), F.lit(fields).alias("fields"))
        spec.coalesce(1).write.mode("overwrite").parquet(f"{path}/_buckets")


def _spec(spark: SparkSession, path: str):
    return spark.read.schema("key string, buckets int, fields string").parquet(f"{path}/_buckets").first()


def _enter(spark: SparkSession, path: str, name: str, spec) -> None:
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({spec['fields']}) USING parquet CLUSTERED BY (`{spec['key']}`) SORTED BY (`{spec['key']}`) "
              f"INTO {spec['buckets']} BUCKETS LOCATION '{where}'")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets."""
    path, name = path.rstrip("/"), _name()
    _enter(spark, path, name, _spec(spark, path))
    return spark.table(name)


def buckets_of(spark: SparkSession, path: str) -> int:
    return _spec(spark, path.rstrip("/"))["buckets"]
