"""Plan shape of the registered queries."""

import re

import pytest

from conftest import SF_SMALL
from winnow.plans.catalog import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan after execution (the text also holds the initial plan)."""
    text = plan_of(df)
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    for m in re.finditer(r"Window \[[^\n]*\], \[([^\]]*)\], \[", plan):
        assert m.group(1).strip(), name  # a window without PARTITION BY would run in one task


def test_sample_is_distributed_top_n(spark):
    df = QUERIES["excluded_sample"](spark, SF_SMALL)
    df.collect()
    assert "TakeOrderedAndProject" in plan_of(df)


def test_scan_prunes_columns(spark):
    df = QUERIES["source_counts"](spark, SF_SMALL)
    plan = plan_of(df)
    scans = [l for l in plan.split("\n") if "FileScan parquet" in l and "documents" in l]
    assert scans and all("text" not in s.split("ReadSchema:")[1] for s in scans)


def test_key_counts_read_keys_twice_at_most(spark):
    df = QUERIES["flag_duplicates"](spark, SF_SMALL)
    df.collect()
    final = final_plan(df)
    assert final.count("FileScan parquet") <= 2
    assert "Window" not in final


def test_survivors_plan(spark):
    plan = plan_of(QUERIES["keep_first"](spark, SF_SMALL))
    assert "LeftSemi" in plan and "Window" not in plan and "SortAggregate" not in plan


TAGGED = {"manual_screen", "manual_screen_counts", "cooccurrence", "method_application_matrix", "temporal_trends", "category_counts",
          "category_counts_by_source", "stack_offsets", "distribution", "any_label_count", "venn_regions", "venn_regions_all",
          "stored_annotations", "venn_occurring", "inclusive_overlaps", "cooccurrence_bitmaps",
          "multi_value_counts", "value_coverage", "prisma_flow"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TAGGED - {"score_labels_cosine"}))
def test_labels_are_read_only_for_tags(spark, name):
    assert "labels.parquet" not in plan_of(QUERIES[name](spark, SF_SMALL))


def test_building_queries_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    stored = {"stored_identification", "identification_in_batches", "stored_annotations", "stored_scores"}  # they write and read again
    for name in set(QUERIES) - stored:
        QUERIES[name](spark, SF_SMALL)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_labels_are_unique(spark):
    """The tags' join adds no row."""
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert labels.count() == labels.select("doc_id").distinct().count()


def test_screen_has_no_optimiser_fence(spark):
    for name in ("score_screen", "max_score_bands", "excluded_sample"):
        assert "CollectMetrics" not in plan_of(QUERIES[name](spark, SF_SMALL))


def test_scores_are_evaluated_once(spark):
    """Filters, bands and sheets above the scores copy none of their expressions."""
    base = QUERIES["keep_first"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")
    for name in ("two_dimension_tags", "score_screen", "max_score_bands", "excluded_sample", "borderline_sheet", "sample_sheet"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("array_intersect") <= 7 and plan.count("regexp_replace") <= base, name
