"""Stored scores that follow their candidates (SRC-9, SNK-7).

A score depends on a text, a label and a scorer, not on a run. The store keeps one
row a candidate digest (of the text columns that the scorer reads) with a column
for each label, in a folder for each version of the scorer. When the candidates
change, ``update`` scores just those that the store lacks (an anti-join by digest) and
appends them; ``attach`` joins the scores to the candidates of today. Labels that
the store has no column for raise (stale scores), and so does a candidate without
scores when its row is read: a gap is never a zero.

Digests are the buckets' key, so neither join moves the store. Rows enter whole: a
write that fails leaves rows that are right or none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import lc
from ..operators.screen import keep_first
from ..operators.score import score_of
from ..session import checkpoint
from . import buckets
from .tables import committed

CANDIDATE = "candidate"
Scorer = Callable[[DataFrame, Sequence[str]], DataFrame]


def candidate_digest(columns: Sequence[str] = ("title",)) -> Column:
    """256 bits of the scored columns; null and empty differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), lc(c)), F.lit("-")) for c in columns]), 256)


class ScoreStore:
    """The scores of one version of a scorer under ``path``."""

    def __init__(self, spark: SparkSession, path: str, version: str = "1", columns: Sequence[str] = ("title",)):
        self.spark, self.columns = spark, tuple(columns)
        self.path = f"{path.rstrip('/')}/scorer={version}"

    def exists(self) -> bool:
        return committed(self.spark, f"{self.path}/_buckets")

    def read(self, labels: Sequence[str]) -> DataFrame:
        """(candidate, label columns), one row a candidate; a label without a column raises."""
        stored = buckets.read(self.spark, self.path)
        missing = [l for l in labels if l not in stored.columns]
        if missing:
            raise RuntimeError(f"Stale scores in {self.path}: no column for {missing}")
        rows = stored.select(CANDIDATE, *[lc(l) for l in labels])
        # two runs that update at once may both enter a candidate
        return rows.groupBy(CANDIDATE).agg(*[F.first(lc(l)).alias(l) for l in labels])

    def missing(self, candidates: DataFrame, labels: Sequence[str]) -> DataFrame:
        """The first candidate (least ``row_id``) of each digest without scores."""
        rows = candidates.withColumn(CANDIDATE, candidate_digest(self.columns))
        if self.exists():
            rows = rows.join(self.read(labels).select(CANDIDATE), CANDIDATE, "left_anti")
        return keep_first(rows, key=CANDIDATE)

    def update(self, candidates: DataFrame, labels: Sequence[str], scorer: Scorer) -> bool:
        """Score and store what is missing; whether there was anything.
        ``scorer(candidates, labels)`` gives ``row_id`` and a ``scores`` map."""
        todo = checkpoint(self.missing(candidates, labels))
        known = self.exists()
        if known and todo.isEmpty():
            return False
        scored = scorer(todo.drop(CANDIDATE), labels).select("row_id", "scores")
        rows = todo.select("row_id", CANDIDATE).join(scored, "row_id")
        rows = rows.select(CANDIDATE, *[score_of("scores", l).alias(l) for l in labels])
        if known:
            stored = buckets.read(self.spark, self.path).columns[1:]
            extra = [l for l in stored if l not in labels]
            if extra:  # new rows need every column of the store
                raise RuntimeError(f"Stale scores in {self.path}: new candidates need scores for {extra} too")
            rows = rows.select(CANDIDATE, *[lc(l) for l in stored])
            buckets.write(rows, self.path, CANDIDATE, buckets.buckets_of(self.spark, self.path), "append")
        else:
            buckets.write(rows, self.path, CANDIDATE)
        return True

    def attach(self, candidates: DataFrame, labels: Sequence[str], out: str = "scores") -> DataFrame:
        """``candidates`` with ``out``, a map of the labels' scores."""
        stored = self.read(labels)
        as_map = F.create_map(*[x for l in labels for x in (F.lit(l), lc(l))])
        stored = stored.select(F.col(CANDIDATE).alias("_c"), as_map.alias("_scores"))
        rows = candidates.withColumn(CANDIDATE, candidate_digest(self.columns))
        joined = rows.join(stored, F.col(CANDIDATE) == F.col("_c"), "left")
        gap = F.raise_error(F.concat(F.lit("no scores for row "), F.col("row_id").cast("string"))).cast("map<string,double>")
        return joined.select(*[lc(c) for c in candidates.columns], F.when(F.col("_c").isNull(), gap).otherwise(F.col("_scores")).alias(out))
