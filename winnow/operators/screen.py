"""Survivors, screens and validation sheets (DED-3, FLT-1..7, AGG-19, SRT-3,
SNK-2/3/6 shapes)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (BORDERLINE_LOW, CANCER_TYPE, NOT_RELEVANT, READER_COLUMNS, SAMPLE_SEED, SAMPLE_SIZE,
                                   SCREEN_THRESHOLD)
from ..functions.nulls import any_is_one, count_if, not_one
from .report import lc, require
from .skew import key_digest

TEMPLATE_RECORD_COLUMNS = ("row_id", "dedup_key", "title", "authors", "year", "doi", "source")
EXPORT_RECORD_COLUMNS = ("title", "authors", "year", "doi", "source")


def drop_secondary(flagged: DataFrame) -> DataFrame:
    """FLT-1."""
    return flagged.filter(~F.col("flag_review_conf"))


def keep_first(df: DataFrame, key: str = "dedup_key", order: str = "row_id", where: Column | None = None) -> DataFrame:
    """DED-3: the first row of each key in ``order`` (concatenation order),
    among the rows satisfying ``where`` (keys without such a row drop out).

    The least ``order`` per key is a hash aggregate over (key digest, long),
    pre-reduced by every map task, so a key holding a third of all rows costs
    one row per task; the rows are then semi-joined on the unique ``order``.
    Neither step sorts rows by their text keys. Not ``dropDuplicates``, which
    keeps an arbitrary row.
    """
    rows = df if where is None else df.filter(where)
    first = rows.groupBy(key_digest(lc(key)).alias("_kd")).agg(F.min(lc(order)).alias("_first"))
    return df.join(first.select("_first"), lc(order) == F.col("_first"), "left_semi")


def survivors(flagged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """SCO-1 / template rows: secondary papers removed *before* keep-first, so a key
    whose first row is one survives through a later clean row."""
    out = keep_first(flagged, where=~F.col("flag_review_conf"))
    return out if columns is None else out.select(*[lc(c) for c in columns])


def annotation_template(flagged: DataFrame, method_labels: Sequence[str], application_labels: Sequence[str],
                        not_relevant: str = NOT_RELEVANT, cancer_type: str = CANCER_TYPE) -> DataFrame:
    """SNK-2 / PRJ-2: survivors with every tag 0, ``Not Relevant`` 0 and a blank
    ``Cancer Type``, in a fixed column order. ``row_id`` and ``dedup_key`` are
    kept so annotations can be joined back by key."""
    s = survivors(flagged, TEMPLATE_RECORD_COLUMNS)
    tags = {l: F.lit(0) for l in [*method_labels, *application_labels, not_relevant]}
    return s.select(*[lc(c) for c in TEMPLATE_RECORD_COLUMNS],
                    *[v.alias(k) for k, v in tags.items()], F.lit("").alias(cancer_type))


def manual_screen_condition(method_labels: Sequence[str], not_relevant: str = NOT_RELEVANT) -> Column:
    """FLT-2: any method tag equal to 1 AND ``Not Relevant`` not equal to 1
    (a null ``Not Relevant`` passes)."""
    return any_is_one([lc(l) for l in method_labels]) & not_one(lc(not_relevant))


def manual_screen(annotated: DataFrame, method_labels: Sequence[str], not_relevant: str = NOT_RELEVANT) -> DataFrame:
    require(annotated, [*method_labels, not_relevant])
    return annotated.filter(manual_screen_condition(method_labels, not_relevant))


def screened_export(screened: DataFrame, labels: Sequence[str]) -> DataFrame:
    """SNK-3 / PRJ-1: record columns + tags, in export order."""
    return screened.select(*[lc(c) for c in (*EXPORT_RECORD_COLUMNS, *labels)])


def manual_screen_counts(annotated: DataFrame, method_labels: Sequence[str],
                         not_relevant: str = NOT_RELEVANT) -> DataFrame:
    """FLT-3: included, excluded (= total - included) and total, one pass."""
    return annotated.agg(
        count_if(manual_screen_condition(method_labels, not_relevant)).cast("long").alias("included"),
        F.count(F.lit(1)).alias("total"),
    ).select("included", (F.col("total") - F.col("included")).alias("excluded"), "total")


# ---------------------------------------------------------------------------
# Score-based screen and validation bands
# ---------------------------------------------------------------------------

def row_max(cols: Sequence[Column]) -> Column:
    """AGG-19: row-wise maximum, nulls skipped (``greatest`` needs two inputs)."""
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def score_screen_condition(score_cols: Sequence[str], threshold: float = SCREEN_THRESHOLD) -> Column:
    """FLT-4: any score strictly above the threshold; never null."""
    return reduce(lambda a, b: a | b, [F.coalesce(lc(c) > F.lit(threshold), F.lit(False)) for c in score_cols])


def score_screen(scored: DataFrame, score_cols: Sequence[str], threshold: float = SCREEN_THRESHOLD) -> DataFrame:
    """FLT-4 as a column."""
    return scored.withColumn("title_screen_pass", score_screen_condition(score_cols, threshold))


def excluded_with_max(screened: DataFrame, score_cols: Sequence[str]) -> DataFrame:
    """FLT-5 + AGG-19: rows that failed the screen, with ``max_score``."""
    return (screened.filter(~F.col("title_screen_pass"))
            .withColumn("max_score", row_max([lc(c) for c in score_cols])))


def score_bands(excluded: DataFrame, low: float = BORDERLINE_LOW, high: float | None = None) -> DataFrame:
    """FLT-6 / FLT-7: ``borderline`` when low <= max (< high if given), ``deep``
    when max < low; a null max is in no band."""
    m = F.col("max_score")
    border = m >= F.lit(low)
    if high is not None:
        border = border & (m < F.lit(high))
    return excluded.withColumn("band", F.when(border, "borderline").when(m < F.lit(low), "deep"))


def reader_sheet(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SNK-6: columns for a reader plus blank decision columns."""
    return df.select(*[lc(c) for c in cols], *[F.lit("").alias(c) for c in READER_COLUMNS])


def borderline_sheet(excluded: DataFrame, cols: Sequence[str], low: float = BORDERLINE_LOW, high: float | None = None) -> DataFrame:
    """SNK-6 / FLT-6: the borderline rows for a reader, highest maximum first."""
    rows = score_bands(excluded, low, high).filter(F.col("band") == "borderline")
    # a range sort reads its input twice (bounds, then rows): the second time from this exchange, not from the scores' input
    return reader_sheet(rows, cols).repartition("row_id").orderBy(F.desc("max_score"), "row_id")


def sample_sheet(excluded: DataFrame, cols: Sequence[str], low: float = BORDERLINE_LOW, n: int = SAMPLE_SIZE,
                 seed: int = SAMPLE_SEED) -> DataFrame:
    """SNK-6 / SRT-3: the seeded sample of the rows under the band, highest maximum first."""
    rows = seeded_sample(excluded.filter(F.col("max_score") < F.lit(low)), n, seed)
    return reader_sheet(rows, cols).orderBy(F.desc("max_score"), "row_id")


def seeded_sample(df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, id_col: str = "row_id") -> DataFrame:
    """SRT-3: exactly ``min(n, rows)`` rows, repeatable, without replacement:
    bottom-n by ``md5('<seed>:' || id)`` (planned as a distributed top-n)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), lc(id_col).cast("string")))
    return df.orderBy(h, lc(id_col)).limit(n)
