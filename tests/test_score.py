"""Scorers: lexical and cosine as Column expressions, a user model through
mapInPandas, thresholds, top labels and the dimension join."""

import math

import pytest
from pyspark.sql import functions as F

from winnow.operators import score
from winnow.operators.screen import excluded_with_max, score_bands, score_screen, seeded_sample


def test_lexical(spark):
    df = spark.createDataFrame([(1, "The cat of the hat"), (2, None), (3, "AND of the")], "row_id long, title string")
    s = score.with_lexical_scores(df, "title", ["the of and", "cat", "!!"])
    got = {(r["row_id"], r["label"]): r["score"] for r in score.scores_long(s, ["row_id"], ["the of and", "cat", "!!"]).collect()}
    assert got[(1, "the of and")] == round(2 / 3, 4) and got[(1, "cat")] == 1.0 and got[(1, "!!")] == 0.0
    assert got[(2, "the of and")] == 0.0 and got[(3, "the of and")] == 1.0


def test_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], "vec_id long, v array<float>")
    vecs = score.label_vectors(spark.createDataFrame([(0, [1.0, 0.0], 5), (1, [0.0, 1.0], 5), (2, [9.0, 9.0], 6)],
                                                     "vec_id long, v array<float>, label int"),
                               "label", "v", "vec_id")
    assert {r["label"]: r["vec"] for r in vecs.collect()} == {"5": [1.0, 0.0], "6": [9.0, 9.0]}
    out = score.cosine_scores(df, "v", vecs)
    got = {(r["vec_id"], r["label"]): r["score"] for r in score.map_scores_long(out, ["vec_id"]).collect()}
    assert got[(1, "5")] == 1.0 and got[(2, "5")] == round(1 / math.sqrt(2), 4) and got[(2, "6")] == 1.0


def _make_stub():
    """Built inside a function so the workers get it by value."""
    def factory():
        def model(texts, labels):
            out = []
            for t in texts:
                s = [((len(t) + i) % 10) / 10 for i in range(len(labels))]
                order = sorted(range(len(labels)), key=lambda i: -s[i])
                out.append({"labels": [labels[i] for i in order], "scores": [s[i] for i in order]})
            return out
        return model
    return factory


@pytest.mark.parametrize("batch", [1, 7, 32])
def test_model_scorer_batches(spark, batch):
    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "row_id long, title string").repartition(3)
    scored = score.model_scores(df, "title", ["a", "b"], _make_stub(), batch_size=batch)
    got = {r["row_id"]: r["scores"] for r in scored.collect()}
    assert len(got) == 50
    assert got[13] == {"a": 0.3, "b": 0.4}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan or "PythonMapInArrow" in plan or "MapInArrow" in plan


def test_model_scorer_empty_input(spark):
    df = spark.createDataFrame([], "row_id long, title string")
    assert score.model_scores(df, "title", ["a"], _make_stub()).count() == 0


def test_threshold_is_strict_and_rounding(spark):
    df = spark.createDataFrame([(1, {"a": 0.35, "b": 0.123456}), (2, {"a": 0.3500001})],
                               "row_id long, scores map<string,double>")
    t = {r["row_id"]: r for r in score.threshold_tags(df, ["a", "b"], 0.35).collect()}
    assert t[1]["a"] == 0 and t[2]["a"] == 1
    assert t[1]["b_score"] == 0.1235 and t[2]["b"] == 0 and t[2]["b_score"] == 0.0


def test_top_labels_ties(spark):
    df = spark.createDataFrame([(1, {"c": 0.5, "a": 0.5, "b": 0.9, "d": 0.1})], "row_id long, scores map<string,double>")
    got = [(r["rank"], r["label"], r["score"]) for r in score.top_labels(df, ["row_id"], 3).orderBy("rank").collect()]
    assert got == [(1, "b", 0.9), (2, "a", 0.5), (3, "c", 0.5)]


def test_merge_suffix_on_clash(spark):
    left = spark.createDataFrame([("k1", 1, 0.9), ("k2", 0, 0.1)], "dedup_key string, x int, x_score double")
    right = spark.createDataFrame([("k1", 1, 0.8, "drop")], "dedup_key string, x int, x_score double, other string")
    out = score.merge_dimensions(left, right, ["x"])
    assert out.columns == ["dedup_key", "x", "x_score", "x_app", "x_score_app"]
    got = {r["dedup_key"]: r for r in out.collect()}
    assert got["k1"]["x_app"] == 1 and got["k2"]["x_app"] is None


def test_screen_bands_and_sample(spark):
    rows = [(i, (i % 10) / 10, ((i * 3) % 10) / 10) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, a_score double, b_score double")
    s = score_screen(df, ["a_score", "b_score"], 0.75)
    ex = excluded_with_max(s, ["a_score", "b_score"])
    assert ex.filter(F.col("max_score") > 0.75).count() == 0
    banded = score_bands(ex, low=0.5).groupBy("band").count().collect()
    assert sum(r["count"] for r in banded) == ex.count()
    a = [r["row_id"] for r in seeded_sample(ex, 30).collect()]
    b = [r["row_id"] for r in seeded_sample(ex.repartition(5), 30).collect()]
    assert len(a) == 30 and a == b and len(set(a)) == 30
    plan = seeded_sample(ex, 30)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert seeded_sample(ex.limit(5), 30).count() == 5


def test_tag_dimensions_equals_join(spark):
    rows = [(i, f"k{i}", "the of and de la" if i % 3 else "to in der und die") for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, dedup_key string, title string")
    m_labels, a_labels = ["the of and", "to in is"], ["der und die", "de la des"]
    scored = score.with_lexical_scores(df, "title", m_labels + a_labels)
    one = score.tag_dimensions(scored, [(0.25, m_labels), (0.3, a_labels)])
    left = score.threshold_tags(score.with_lexical_scores(df, "title", m_labels), m_labels, 0.25)
    right = score.threshold_tags(score.with_lexical_scores(df, "title", a_labels), a_labels, 0.3)
    joined = score.merge_dimensions(left, right, a_labels)
    cols = ["dedup_key", *[c for l in m_labels + a_labels for c in (l, f"{l}_score")]]
    a = sorted(tuple(r) for r in one.select(*[F.col(f"`{c}`") for c in cols]).collect())
    b = sorted(tuple(r) for r in joined.select(*[F.col(f"`{c}`") for c in cols]).collect())
    assert a == b


def test_inference_batches(spark):
    assert score.inference_batches(spark.range(65), 32).first()["batches"] == 3
    assert score.inference_batches(spark.range(0), 32).first()["batches"] == 0


def test_model_cache_separates_factories(spark):
    def make(offset):
        def factory():
            def model(texts, labels):
                return [{"labels": list(labels), "scores": [offset] * len(labels)} for _ in texts]
            return model
        return factory
    df = spark.createDataFrame([(1, "t")], "row_id long, title string").coalesce(1)
    a = score.model_scores(df, "title", ["x"], make(0.1)).first()["scores"]
    b = score.model_scores(df, "title", ["x"], make(0.9)).first()["scores"]
    assert a == {"x": 0.1} and b == {"x": 0.9}


def test_model_is_built_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def factory():
        import os
        import uuid
        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts, labels: [{"labels": labels, "scores": [1.0] * len(labels)} for _ in texts]

    df = spark.createDataFrame([(i, "t") for i in range(160)], "row_id long, title string").repartition(16)
    assert score.model_scores(df, "title", ["x"], factory).count() == 160
    assert score.model_scores(df, "title", ["x"], factory).agg(F.count("scores")).first()[0] == 160
    import os
    built = os.listdir(folder)
    assert built and len(built) == len({b.split("-")[0] for b in built})


def test_cosine_takes_any_number_of_labels(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)], i) for i in range(1500)], "vec_id long, v array<float>, label int")
    out = score.cosine_scores(df.filter("vec_id < 2"), "v", score.label_vectors(df, "label", "v", "vec_id"))
    assert [r["n"] for r in out.select(F.size("scores").alias("n")).collect()] == [1500, 1500]


def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, v array<float>")
    one = spark.createDataFrame([(0, [1.0, 0.0], "a")], "vec_id long, v array<float>, label string")
    out = score.cosine_scores(df, "v", score.label_vectors(one, "label", "v", "vec_id"))
    got = {r["vec_id"]: r["scores"]["a"] for r in out.collect()}
    assert got == {1: None, 2: 1.0}


def test_model_calls_are_full_across_arrow_batches(spark, tmp_path):
    """Every call but a partition's last has ``batch_size`` texts, however Arrow cuts the rows."""
    log = str(tmp_path)

    def factory():
        def model(texts, labels):
            import os
            import uuid
            open(os.path.join(log, f"{len(texts)}-{uuid.uuid4().hex}"), "w").close()
            return [{"labels": labels, "scores": [float(len(t))] * len(labels)} for t in texts]
        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 100, 1, 3).selectExpr("id as row_id", "repeat('x', cast(id as int)) as title")
        rows = score.model_scores(df, "title", ["a"], factory, batch_size=16, id_cols=("row_id", "title")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["row_id"]: r["scores"]["a"] for r in rows} == {i: float(i) for i in range(100)} and all(r["title"] == "x" * r["row_id"] for r in rows)
    calls = sorted(int(n.split("-")[0]) for n in __import__("os").listdir(log))
    assert len(calls) == 9 and calls == [1, 1, 2] + [16] * 6  # partitions of 33, 33 and 34 rows
    assert score.model_calls(df, 16).first()["batches"] == 9 and score.inference_batches(df, 16).first()["batches"] == 7


def test_indexed_top_labels_equal_the_map_form(spark):
    import random
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    labels = sorted({" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(3000)} | {"!!", "w1 w1", "zz none"})
    titles = [" ".join(rng.sample(words, rng.randrange(1, 7))) for _ in range(30)] + [None, "", "nothing here", "w59", "zz"]
    df = spark.createDataFrame(list(enumerate(titles)), "row_id long, title string")
    table = spark.createDataFrame([(l,) for l in labels], "label string")
    for some in (labels[:150], labels[:2]):
        want = score.top_labels(score.with_lexical_scores(df, "title", some), ["row_id"], 3).collect()
        got = score.top_labels_indexed(df, ["row_id"], "title", spark.createDataFrame([(l,) for l in some], "label string"), 3).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    every = score.top_labels_indexed(df, ["row_id"], "title", table, 5).collect()
    assert len(every) == 5 * len(titles) and {r["score"] for r in every if r["row_id"] == 30} == {0.0}
    best = {r["row_id"]: r["label"] for r in every if r["rank"] == 1}
    assert best[33] == "w59" if "w59" in labels else True


def test_scores_are_generated_once(spark):
    df = spark.createDataFrame([(1, "the cat"), (2, None)], "row_id long, title string")
    s = score.with_lexical_scores(df, "title", ["the cat", "dog"])
    tagged = score.threshold_tags(s, ["the cat", "dog"], 0.4).filter("`the cat_score` > 0.1 or dog_score > 0.1").filter("`the cat` = 1")
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 2 and [r["row_id"] for r in tagged.collect()] == [1]
