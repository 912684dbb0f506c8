"""End-to-end workflows (PIP-1..3): two explicit jobs with a table between
them instead of a gate hidden in file existence.

1. ``identification`` - exports -> harmonised records (dense ``row_id``) ->
   flagged table (written once) -> summary tables.
2. ``build_template`` - flagged table -> annotation template for a person.
3. ``report`` - annotated table -> screen -> every count table of the report.

Each step writes Parquet (and optional CSV) to the folders it is given;
nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import (APPLICATION_LABELS, BORDERLINE_LOW, CANCER_TYPE, DIMENSION_TAG_THRESHOLD, METHOD_LABELS,
                                   NOT_RELEVANT, SAMPLE_SEED, SAMPLE_SIZE, SCREEN_THRESHOLD, SOURCES)
from ..functions.nulls import count_if
from ..operators import identify as ident
from ..operators import report as rep
from ..operators import score, screen
from ..operators.skew import key_digest
from ..sources import buckets, exports, tables
from ..sources.score_store import ScoreStore


def load_exports(spark: SparkSession, pubmed: str | Sequence[str], scopus: str | Sequence[str],
                 ieee: str | Sequence[str], quarantine: str | None = None) -> DataFrame:
    """SRC-1..5 + SET-1 + DED-4: three CSV exports to one record table. A row with
    surplus cells is an error; with ``quarantine`` such rows are written there
    instead, with source, file and text."""
    paths = dict(zip(SOURCES, (pubmed, scopus, ieee)))
    if quarantine is None:
        return exports.harmonise(*[exports.read_export(spark, p) for p in paths.values()])
    parts = {s: exports.read_export_parts(spark, p) for s, p in paths.items()}
    bad = [b.withColumn("source", F.lit(s)) for s, (_, b) in parts.items()]
    tables.write_table(bad[0].unionByName(bad[1]).unionByName(bad[2]), quarantine)
    return exports.harmonise(*[good for good, _ in parts.values()])


def identification(spark: SparkSession, pubmed: str | Sequence[str], scopus: str | Sequence[str],
                   ieee: str | Sequence[str], out_dir: str, csv: bool = False, quarantine: bool = False) -> DataFrame:
    """PIP-1: flagged table, written to ``out_dir/flagged`` (Parquet) and read
    back, so later steps start from the stored table (SRC-8). ``quarantine`` sets
    rows with surplus cells aside in ``out_dir/quarantine``, in a folder for the
    inputs as the flagged table has one."""
    key = tables.input_fingerprint(spark, pubmed, scopus, ieee)
    out = out_dir.rstrip("/")
    aside = f"{out}/quarantine/fp={key}" if quarantine else None
    flagged = tables.read_or_build(
        spark, f"{out}/flagged", lambda: ident.identify(load_exports(spark, pubmed, scopus, ieee, aside)),
        key=tables.fingerprint(key, "quarantine") if quarantine else key)
    if csv:
        tables.write_csv(flagged, f"{out}/flagged_csv")  # row_id kept: keep-first order
    return flagged


def identification_tables(flagged: DataFrame) -> dict[str, DataFrame]:
    """PIP-3 / AGG-5..7: the summary printed after identification, as tables."""
    return {
        "identification_summary": rep.identification_summary(flagged),
        "qa_missing": rep.qa_missing(flagged),
        "source_counts": rep.source_counts(flagged),
    }


def build_template(flagged: DataFrame, out_path: str | None = None,
                   method_labels: Sequence[str] = METHOD_LABELS,
                   application_labels: Sequence[str] = APPLICATION_LABELS) -> DataFrame:
    """SNK-2: template rows (survivors with zeroed tags); written as CSV when
    ``out_path`` is given."""
    t = screen.annotation_template(flagged, method_labels, application_labels)
    if out_path:
        tables.write_csv(t, out_path)
    return t


def report(annotated: DataFrame, flagged: DataFrame | None = None, out_dir: str | None = None,
           method_labels: Sequence[str] = METHOD_LABELS, application_labels: Sequence[str] = APPLICATION_LABELS,
           not_relevant: str = NOT_RELEVANT, category: str = CANCER_TYPE, min_year: int = 2021,
           short: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """PIP-2 (phase 2): screen the annotated table and build every report table.

    With ``out_dir`` the annotated table is first written there as Parquet, so
    its CSV is read once and every table starts from columns; the tables are
    written beside it (one folder each)."""
    if out_dir:
        tables.write_table(annotated, f"{out_dir.rstrip('/')}/annotated")
        annotated = annotated.sparkSession.read.parquet(f"{out_dir.rstrip('/')}/annotated")
    screened = screen.manual_screen(annotated, method_labels, not_relevant)
    labels = [*method_labels, *application_labels]
    dims = {"methods": list(method_labels), "applications": list(application_labels)}
    out = {
        "temporal_trends": rep.temporal_trends(annotated, method_labels, min_year=min_year),
        "category_counts": rep.category_counts(annotated, dims),
        "category_counts_by_source": rep.stack_offsets(rep.category_counts_by_source(annotated, dims)),
        "cooccurrence": rep.cooccurrence(annotated, dims),
        "method_application_matrix": rep.method_application_matrix(annotated, method_labels, application_labels, short),
        "manual_screen_counts": screen.manual_screen_counts(annotated, method_labels, not_relevant),
        "venn_regions": rep.venn_regions(screened, method_labels, strict=len(method_labels) == 3),
        "distribution": rep.distribution(screened, dims),
        "any_label_count": rep.any_label_counts(screened, dims),
        "multi_value_counts": rep.multi_value_counts(screened, category),
        "value_coverage": rep.value_coverage(screened, category),
        "screened_export": screen.screened_export(screened, labels),
    }
    if flagged is not None:
        out["prisma_flow"] = rep.prisma_flow(flagged, annotated, method_labels, not_relevant)
    if out_dir:
        for name, df in out.items():
            tables.write_table(df, f"{out_dir.rstrip('/')}/{name}")
    return out


CANDIDATE_COLUMNS = ("row_id", "dedup_key", "title", "authors", "year", "doi", "source")


def score_screen(flagged: DataFrame, scorer: Callable[[DataFrame, Sequence[str]], DataFrame], out_dir: str,
                 method_labels: Sequence[str] = METHOD_LABELS, application_labels: Sequence[str] = APPLICATION_LABELS,
                 tag_threshold: float = DIMENSION_TAG_THRESHOLD, screen_threshold: float = SCREEN_THRESHOLD,
                 version: str = "1") -> dict[str, DataFrame]:
    """SCO-1..4, SNK-5, SNK-7, SRC-9: candidates, scores, tags, screen.

    ``scorer(candidates, labels)`` gives ``row_id`` and a ``scores`` map (for
    example ``score.model_scores`` with a user model). Scores are kept under
    ``out_dir/scores`` by scorer version and candidate: a later run scores only
    candidates that are new, and labels without stored scores raise. Tags of both
    dimensions come from the one scoring pass. Written: ``merged_tags``,
    ``screened`` and ``screen_counts``."""
    spark, out = flagged.sparkSession, out_dir.rstrip("/")
    labels = [*method_labels, *application_labels]
    candidates = screen.survivors(flagged, CANDIDATE_COLUMNS)
    store = ScoreStore(spark, f"{out}/scores", version)
    store.update(candidates, labels, scorer)
    rows = store.attach(candidates, labels)
    tagged = score.tag_dimensions(rows, [(tag_threshold, method_labels), (tag_threshold, application_labels)])
    tables.write_table(screen.score_screen(tagged, [f"{l}_score" for l in method_labels], screen_threshold), f"{out}/merged_tags")
    merged = spark.read.parquet(f"{out}/merged_tags")
    passed = merged.filter("title_screen_pass")
    counts = merged.agg(count_if(F.col("title_screen_pass")).alias("included"), count_if(~F.col("title_screen_pass")).alias("excluded"),
                        F.count(F.lit(1)).alias("total"))
    written = {"merged_tags": merged, "screened": passed, "screen_counts": counts}
    for name in ("screened", "screen_counts"):
        tables.write_table(written[name], f"{out}/{name}")
    return written


def validation(merged: DataFrame, out_dir: str, method_labels: Sequence[str] = METHOD_LABELS, low: float = BORDERLINE_LOW,
               n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> dict[str, DataFrame]:
    """SNK-6, FLT-6, SRT-1, SRT-3: the two sheets for a reader from
    ``merged_tags``, highest maximum first, written as CSV."""
    scores = [f"{l}_score" for l in method_labels]
    excluded = screen.excluded_with_max(merged, scores)
    cols = ["row_id", *screen.EXPORT_RECORD_COLUMNS, *scores, "max_score"]
    sheets = {"borderline_sheet": screen.borderline_sheet(excluded, cols, low),
              "sample_sheet": screen.sample_sheet(excluded, cols, low, n, seed)}
    for name, df in sheets.items():
        tables.write_csv(df, f"{out_dir.rstrip('/')}/{name}")
    return sheets


def join_annotations(template_rows: DataFrame, annotations: DataFrame, labels: Sequence[str],
                     extra: Sequence[str] = (NOT_RELEVANT, CANCER_TYPE)) -> DataFrame:
    """Attach a person's tags to survivors by ``dedup_key`` (one row per key
    on both sides, so a plain equi-join without hot keys)."""
    keep = ["dedup_key", *[c for c in [*labels, *extra] if c in annotations.columns]]
    return template_rows.drop(*[c for c in keep if c != "dedup_key"]).join(
        annotations.select(*[F.col(f"`{c}`") for c in keep]), "dedup_key", "left")


def store_survivors(flagged: DataFrame, path: str, n: int = buckets.BUCKETS) -> None:
    """The template's rows bucketed by key digest, for joins without a shuffle."""
    rows = screen.survivors(flagged, CANDIDATE_COLUMNS)
    buckets.write(rows.withColumn(buckets.KEY, key_digest("dedup_key")), path, buckets=n)


def store_annotations(annotations: DataFrame, path: str, n: int = buckets.BUCKETS) -> None:
    """A person's tags (one row a ``dedup_key``) in the same buckets."""
    buckets.write(annotations.withColumn(buckets.KEY, key_digest("dedup_key")), path, buckets=n)


def annotated_survivors(spark: SparkSession, survivors: str, annotations: str, labels: Sequence[str],
                        extra: Sequence[str] = (NOT_RELEVANT, CANCER_TYPE)) -> DataFrame:
    """``join_annotations`` of the two stored tables, bucket by bucket."""
    tags = buckets.read(spark, annotations)
    keep = [c for c in [*labels, *extra] if c in tags.columns]
    rows = buckets.read(spark, survivors).join(tags.select(buckets.KEY, *[F.col(f"`{c}`") for c in keep]), buckets.KEY, "left")
    return rows.drop(buckets.KEY)
