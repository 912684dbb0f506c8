import numpy as np

from pyspark.sql import functions as F

from winnow.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "'x' as v", "'x' as key", "1 as tree", "1 as query_id")


def exact(rows, k, every):
    out = {}
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for i, q in good:
        if i % every == 0:
            ranked = sorted((-float(q @ v), j) for j, v in good if j != i)
            out[i] = [j for _, j in ranked[:k]]
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.5 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(6000)]
    got = N.nearest(frame(spark, rows), F.col("vec_id") % 200 == 0, k=10, leaf=64, visit=0.3)
    found = {}
    for r in got.collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    want = exact(rows, 10, 200)
    assert set(found) == set(want) and all(sorted(f) == list(range(1, 11)) for f in found.values())
    assert np.mean([len(set(found[q].values()) & set(w)) / 10 for q, w in want.items()]) >= 0.9


def test_edges_are_exact_when_all_leaves_are_visited(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 1.0]) for i in range(120)]  # a vector that many rows share
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (2020, [float("nan")] * 6),
             (2040, [float("inf")] * 6), (None, [1.0] * 6), (2060, [1.0, 2.0])]
    got = {}
    for r in N.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, leaf=16).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = exact([r for r in rows if r[1] is None or len(r[1]) == 6], 20, 20)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == want


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 3, 0.5)]
    assert N.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert N.nearest(frame(spark, [(0, None)]), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_ids_have_a_defined_result(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(60)]
    rows += [(i % 7, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(40)] + rows[:10] * 30  # ids with several vectors, repeated rows
    rows = [r for r in rows if any(r[1])]
    df = frame(spark, rows)
    got = {}
    for r in N.nearest(df.repartition(5), F.col("vec_id") % 5 == 0, k=30).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asks = {}
    for i, v in rows:
        if i % 5 == 0:
            asks[i] = min(asks.get(i, v), v)
    assert set(got) == set(asks)
    for q, v in asks.items():
        best = {}
        for i, x in rows:
            if i != q:
                best[i] = max(best.get(i, -1e9), float(np.dot(v, x)))
        want = sorted(best.items(), key=lambda b: (-b[1], b[0]))[:30]
        assert [(i, s) for _, i, s in sorted(got[q])] == want
