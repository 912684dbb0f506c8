"""Counts over many runs (AGG-2, AGG-3, PIP-3).

A run's exact counts can't be added up to distinct keys of several runs. Each run
therefore stores, beside its exact counts, a sketch of its keys for every group
(all keys, flagged keys, survivors, and those of each source); sketches of any
runs are united without reading their rows again. Row counts that only the writing
job sees are taken by ``observe`` in that job, with no second pass.

Sketches are HyperLogLog sketches of 2^``LOG_K`` buckets; the relative standard error of an
estimate is at most 1.04 / sqrt(2^``LOG_K``), 0.8 % here; below some thousands of keys they
count exactly or nearly so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import SOURCES
from ..operators.skew import key_digest
from ..sources import tables

LOG_K = 14
ERROR = 1.04 / 2 ** (LOG_K / 2)


def key_sketches(flagged: DataFrame) -> DataFrame:
    """``(metric, n, sketch)``: distinct keys of a flagged table by group, exact and as a sketch.

    One aggregate by key (a row a key, partial aggregation first), then one over keys."""
    marks = {"keys": F.lit(True), "flagged_keys": F.col("_any"), "template_keys": ~F.col("_all")}
    marks |= {f"keys_{s}": F.col(f"_{s}") for s in SOURCES}
    keys = flagged.groupBy(key_digest("dedup_key").alias("_kd")).agg(
        F.bool_or("flag_review_conf").alias("_any"), F.bool_and("flag_review_conf").alias("_all"),
        *[F.bool_or(F.coalesce(F.col("source") == s, F.lit(False))).alias(f"_{s}") for s in SOURCES])
    row = keys.agg(*[x for m, c in marks.items() for x in (
        F.count_if(c).alias(f"n_{m}"), F.hll_sketch_agg(F.when(c, F.col("_kd")), LOG_K).alias(f"s_{m}"))])
    return row.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"n_{m}").alias("n"), F.col(f"s_{m}").alias("sketch")) for m in marks])))


def write_observed(df: DataFrame, path: str, name: str = "written") -> dict:
    """Write ``df`` as a table; rows, and nulls of each column, as the same job counted them."""
    seen = Observation(name)
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in df.columns]
    tables.write_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), path)
    return seen.get


def store_run(flagged: DataFrame, path: str, run: str) -> DataFrame:
    """Store the run's counts and sketches under ``path/run=<run>``; a run is replaced, not added twice."""
    at = f"{path.rstrip('/')}/run={run}"
    tables.write_table(key_sketches(flagged), at)
    return flagged.sparkSession.read.parquet(at)


def over_runs(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """``(metric, runs, n_added, n_distinct)`` over the stored runs (all, or those
    named): the sum of the runs' own counts, and the estimate of different keys in
    all of them together."""
    stored = spark.read.schema("metric string, n long, sketch binary, run string").option("basePath", path).parquet(path)
    stored = stored if runs is None else stored.filter(F.col("run").isin(runs))
    return stored.groupBy("metric").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("n_added"),
                                        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
