"""Sketches and observed counts of runs, against exact counts."""

from pyspark.sql import functions as F

from winnow.plans import metrics


def flagged(spark, low, high):
    return spark.range(low, high).select(
        F.concat(F.lit("k"), (F.col("id") % 40_000).cast("string")).alias("dedup_key"), (F.col("id") % 7 == 0).alias("flag_review_conf"),
        F.element_at(F.array(F.lit("PubMed"), F.lit("Scopus"), F.lit("IEEE"), F.lit(None).cast("string")), (F.col("id") % 4 + 1).cast("int")).alias("source"))


def test_union_over_runs_is_within_the_stated_error(spark, tmp_path):
    runs = {"a": (0, 20_000), "b": (10_000, 35_000), "c": (35_000, 60_000)}
    for run, (low, high) in runs.items():
        for _ in range(2):  # a run that is stored again counts once
            stored = metrics.store_run(flagged(spark, low, high), str(tmp_path), run)
        exact = {r["metric"]: r["n"] for r in stored.collect()}
        assert exact["keys"] == high - low
    got = {r["metric"]: r for r in metrics.over_runs(spark, str(tmp_path)).collect()}
    every = flagged(spark, 0, 20_000).unionByName(flagged(spark, 10_000, 35_000)).unionByName(flagged(spark, 35_000, 60_000))
    want = {"keys": every, "flagged_keys": every.filter("flag_review_conf"), "keys_PubMed": every.filter("source = 'PubMed'")}
    for metric, rows in want.items():
        n = rows.select("dedup_key").distinct().count()
        assert abs(got[metric]["n_distinct"] - n) <= 3 * metrics.ERROR * n and got[metric]["runs"] == 3
    assert got["keys"]["n_added"] == 70_000
    two = {r["metric"]: r for r in metrics.over_runs(spark, str(tmp_path), ["a", "b"]).collect()}
    assert abs(two["keys"]["n_distinct"] - 35_000) <= 3 * metrics.ERROR * 35_000


def test_a_writing_job_counts_its_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a long, `b c` string")
    assert metrics.write_observed(df, f"{tmp_path}/t") == {"rows": 3, "null_a": 1, "null_b c": 2}
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_sketches_of_an_empty_table(spark, tmp_path):
    metrics.store_run(flagged(spark, 0, 0), str(tmp_path), "none")
    assert {(r["n_added"], r["n_distinct"]) for r in metrics.over_runs(spark, str(tmp_path)).collect()} == {(0, 0)}
