"""Stored tables that change over time: buckets, scores by candidate, batches of files."""

import os

import pytest
from pyspark.sql import functions as F

from winnow.operators import report, score, screen
from winnow.plans import workflow
from winnow.plans.increments import Increments
from winnow.sources import buckets
from winnow.sources.score_store import ScoreStore


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def keyed(spark, n, shift=0, **columns):
    return spark.range(shift, shift + n).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias(buckets.KEY),
                                                *[F.expr(e).alias(c) for c, e in columns.items()])


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buckets.write(keyed(spark, 200, row="id", title="cast(id as string)"), f"{tmp_path}/survivors", buckets=4)
        buckets.write(keyed(spark, 150, tag="id % 2"), f"{tmp_path}/annotations", buckets=4)
        buckets.write(keyed(spark, 250, 50, score="id / 10"), f"{tmp_path}/scores", buckets=4)
        a, b, c = (buckets.read(spark, f"{tmp_path}/{t}") for t in ("survivors", "annotations", "scores"))
        out = a.join(b, buckets.KEY, "left").join(c, buckets.KEY, "left")
        plan = plan_of(out)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        rows = {r["row"]: r for r in out.collect()}
        assert len(rows) == 200 and rows[7]["tag"] == 1 and rows[7]["score"] is None and rows[180]["tag"] is None and rows[180]["score"] == 18.0
        # a join keeps the buckets, so its result is stored without a shuffle, and rows are added in place
        buckets.write(a.join(b, buckets.KEY, "left"), f"{tmp_path}/tagged", buckets=4, placed=True)
        buckets.write(keyed(spark, 5, 1000, row="id", title="'new'", tag="id % 2"), f"{tmp_path}/tagged", buckets=4, mode="append")
        tagged = buckets.read(spark, f"{tmp_path}/tagged")
        assert tagged.count() == 205 and "Exchange" not in plan_of(tagged.join(c, buckets.KEY))
        with pytest.raises(ValueError, match="4 buckets"):
            buckets.write(keyed(spark, 5, row="id"), f"{tmp_path}/tagged", buckets=8, mode="append")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_annotations_join_survivors_by_bucket(spark, tmp_path):
    flagged = spark.createDataFrame([(i, f"k{i % 30}", f"T{i}", "A", "2020", "d", "IEEE", False) for i in range(60)],
                                    "row_id long, dedup_key string, title string, authors string, year string, doi string, source string, flag_review_conf boolean")
    workflow.store_survivors(flagged, f"{tmp_path}/survivors", n=4)
    tags = spark.createDataFrame([(f"k{i}", 1.0, None) for i in range(0, 40, 2)], "dedup_key string, m double, x string")
    workflow.store_annotations(tags, f"{tmp_path}/annotations", n=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = workflow.annotated_survivors(spark, f"{tmp_path}/survivors", f"{tmp_path}/annotations", ["m"])
        assert "Exchange" not in plan_of(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r["dedup_key"]: (r["row_id"], r["m"]) for r in out.collect()}
    assert got == {f"k{i}": (i, 1.0 if i % 2 == 0 else None) for i in range(30)}
    joined = workflow.join_annotations(screen.survivors(flagged, workflow.CANDIDATE_COLUMNS), tags, ["m"])
    assert {r["dedup_key"]: (r["row_id"], r["m"]) for r in joined.collect()} == got


LABELS = ["the of", "deep learning"]


def candidates(spark, titles):
    return spark.createDataFrame(list(enumerate(titles)), "row_id long, title string")


def test_a_grown_input_scores_just_the_new_rows(spark, tmp_path):
    seen = []

    def scorer(rows, labels):
        seen.append(sorted((r["title"] or "") for r in rows.collect()))
        return score.with_lexical_scores(rows, "title", labels).select("row_id", "scores")

    store = ScoreStore(spark, str(tmp_path))
    first = candidates(spark, ["The art of x", "Deep learning", "Deep learning", None])
    assert store.update(first, LABELS, scorer) and not store.update(first, LABELS, scorer)
    grown = candidates(spark, ["new of", "Deep learning", None, "The art of x", "", "new of"])
    with pytest.raises(Exception, match="no scores for row"):
        store.attach(grown, LABELS).collect()
    assert store.update(grown, LABELS, scorer) and not store.update(grown, LABELS, scorer)
    assert seen == [["", "Deep learning", "The art of x"], ["", "new of"]]  # null and empty are two candidates
    got = {r["row_id"]: r["scores"] for r in store.attach(grown, LABELS).collect()}
    want = {r["row_id"]: r["scores"] for r in score.with_lexical_scores(grown, "title", LABELS).collect()}
    assert got == want and len(got) == 6
    assert ScoreStore(spark, str(tmp_path), "2").exists() is False
    with pytest.raises(RuntimeError, match="Stale"):
        store.update(grown, [*LABELS, "more"], scorer)
    with pytest.raises(RuntimeError, match="Stale"):
        store.attach(grown, ["more"])
    with pytest.raises(RuntimeError, match="Stale"):  # a new row would lack the other label
        store.update(candidates(spark, ["newer"]), LABELS[:1], scorer)


def test_changed_candidates_keep_no_old_scores(spark, tmp_path):
    from winnow.plans.catalog import LEX_APPLICATIONS, LEX_METHODS

    def flagged(titles):
        rows = [(i, t, t, "A", "2020", "", "IEEE", False) for i, t in enumerate(titles)]
        return spark.createDataFrame(rows, "row_id long, dedup_key string, title string, authors string, year string, doi string, source string, "
                                           "flag_review_conf boolean")

    def scorer(rows, labels):
        return score.with_lexical_scores(rows, "title", labels).select("row_id", "scores")

    for titles in (["the of and", "nothing"], ["nothing", "de la des", "the of and"]):
        merged = workflow.score_screen(flagged(titles), scorer, str(tmp_path), LEX_METHODS, LEX_APPLICATIONS)["merged_tags"]
        assert {r["title"]: r["title_screen_pass"] for r in merged.collect()} == {t: t != "nothing" for t in titles}


HEADS = {"pubmed": "Title,Authors,Publication Year,DOI", "scopus": "Title,Author full names,Year,DOI", "ieee": "Document Title,Authors,Publication Year,DOI"}


def write(folder, source, name, rows):
    os.makedirs(f"{folder}/{source}", exist_ok=True)
    with open(f"{folder}/{source}/{name}.csv", "w", encoding="utf-8") as f:
        f.write("\n".join([HEADS[source], *[",".join(f'"{c}"' for c in r) for r in rows]]) + "\n")


def rows_of(seed, n):
    out = []
    for i in range(n):
        x = (seed * 37 + i * 11) % 23
        title = "" if x == 3 else f"A systematic review of {x}" if x % 7 == 0 else f"Paper {x % 9}"
        out.append((title, f"A{seed}", "" if x % 5 == 4 else str(2015 + x % 4), f"10.1/{x}" if x % 4 == 1 else ""))
    return out


def test_three_batches_equal_one_run(spark, tmp_path):
    folder = f"{tmp_path}/in"
    state = Increments(spark, f"{tmp_path}/state", state_buckets=4)
    arrivals = [{"pubmed": ["b", "d"], "ieee": ["a"]}, {"pubmed": ["a"], "scopus": ["c"]}, {"pubmed": ["c"], "scopus": ["a"], "ieee": ["0", "z"]}]
    seed = 0
    for batch in arrivals:
        for source, names in batch.items():
            for name in names:
                seed += 1
                write(folder, source, name, rows_of(seed, 0 if name == "z" else 12 + seed))
        paths = {s: f"{folder}/{s}" for s in HEADS if os.path.isdir(f"{folder}/{s}")}
        assert state.ingest(**paths) == sum(map(len, batch.values()))
        assert state.ingest(**paths) == 0
    assert state.batches() == 3 and state.manifest().count() == 9
    want = workflow.identification(spark, *[f"{folder}/{s}" for s in HEADS], out_dir=f"{tmp_path}/one")
    got = state.flagged()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.columns == want.columns
    keep = ["row_id", "dedup_key", "title", "authors", "year", "doi", "source"]
    assert sorted(map(tuple, state.survivors().collect())) == sorted(map(tuple, screen.survivors(want, keep).collect()))
    assert sorted(map(tuple, state.summary().collect())) == sorted(map(tuple, report.identification_summary(want).collect()))
    write(folder, "ieee", "a", rows_of(99, 3))
    with pytest.raises(RuntimeError, match="changed"):
        state.ingest(ieee=f"{folder}/ieee")


def test_a_failed_batch_is_done_again(spark, tmp_path, monkeypatch):
    folder, state = f"{tmp_path}/in", Increments(spark, f"{tmp_path}/state", state_buckets=2)
    write(folder, "pubmed", "a", rows_of(1, 20))
    assert state.ingest(pubmed=f"{folder}/pubmed") == 1
    write(folder, "pubmed", "b", rows_of(2, 20))
    with monkeypatch.context() as m:
        m.setattr(Increments, "_merge", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.ingest(pubmed=f"{folder}/pubmed")
    assert state.batches() == 1 and state.flagged().count() == 20
    assert state.ingest(pubmed=f"{folder}/pubmed") == 1 and state.flagged().count() == 40


def test_known_keys_do_not_move(spark, tmp_path):
    folder, state = f"{tmp_path}/in", Increments(spark, f"{tmp_path}/state", state_buckets=2)
    write(folder, "pubmed", "a", rows_of(1, 20))
    state.ingest(pubmed=f"{folder}/pubmed")
    new = spark.createDataFrame([(bytearray(32), 1)], f"{buckets.KEY} binary, _n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(state.keys().join(new, buckets.KEY, "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1
