"""The corpus pipeline: ``documents`` through the stages of ``STAGES``.

Each stage reads all that its predecessor kept, and its decisions take effect:
``run`` writes a stage's rows as Parquet in the shared folder and rereads them
as the next one's documents.

Edge cases: null and empty texts pass every filter (they score clean, link with
nothing, hold no item and no secret) and are packed as one id; of repeated rows
and of near copies one stays, that of the least id, judged by id and text where an
id occurs with several texts; rows with a null id all stay. Further columns,
whatever their names, go through all stages but the last; ``n_chars``, where there
is one, follows the text. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import decontaminate, ngram_join, packing, secret_scan, toxicity
from winnow.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of links stays: that of the least id."""
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    out = secret_scan.redact(docs)
    return out.withColumns({f.name: F.length("text").cast(f.dataType) for f in docs.schema if f.name == "n_chars"})


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]

# The learnt scores and the placing can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
