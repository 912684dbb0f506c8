"""Tiered keys, group sizes (including the hot-key path), survivors."""

from pyspark.sql import functions as F

from winnow.operators.identify import identify, keyed
from winnow.operators.screen import annotation_template, keep_first, survivors
from winnow.operators.skew import attach_key_counts

SCHEMA = "row_id long, title string, authors string, year string, doi string, source string"

KEY_ROWS = [
    (0, "Deep Nets", "A", "2020", "10.1/X", "PubMed"),       # DOI key
    (1, "Deep Nets", "B", "2020", None, "Scopus"),           # DOI twin without DOI: TY key, no match
    (2, "Deep Nets", "C", "2021", None, "IEEE"),             # same title, other year
    (3, "Deep Nets", "D", None, None, "IEEE"),               # same title, no year: T key
    (4, None, "E", "2020", None, "PubMed"),                  # blank: ROW key
    (5, "  ", "F", None, "", "Scopus"),                      # blank: ROW key, must stay apart
    (6, "A Review of Nets", "G", "2020", "doi:10.9/r", "PubMed"),   # flagged first row
    (7, "Nets", "H", "2020", "https://doi.org/10.9/R.", "IEEE"),     # clean row, same key
    (8, "deep  nets", "I", "x2020", None, "Scopus"),         # same TY key as row 1
]


def test_tiers(spark):
    df = keyed(spark.createDataFrame(KEY_ROWS, SCHEMA))
    got = {r["row_id"]: r["dedup_key"] for r in df.collect()}
    assert got == {
        0: "10.1/x", 1: "TY:deep nets|Y:2020", 2: "TY:deep nets|Y:2021", 3: "T:deep nets",
        4: "ROW:4", 5: "ROW:5", 6: "10.9/r", 7: "10.9/r", 8: "TY:deep nets|Y:2020",
    }


def test_group_sizes_and_survivors(spark):
    flagged = identify(spark.createDataFrame(KEY_ROWS, SCHEMA))
    sizes = {r["row_id"]: (r["dup_group_size"], r["flag_duplicate"]) for r in flagged.collect()}
    assert sizes[1] == (2, True) and sizes[8] == (2, True) and sizes[6] == (2, True)
    assert sizes[4] == (1, False) and sizes[5] == (1, False) and sizes[0] == (1, False)
    surv = {r["row_id"] for r in survivors(flagged).collect()}
    # key 10.9/r: first row is flagged, the later clean row survives (Q2)
    assert surv == {0, 1, 2, 3, 4, 5, 7}


def test_hot_key_path_matches_plain_count(spark):
    rows = [(i, f"k{i % 3}" if i % 10 else "hot") for i in range(400)]
    rows += [(1000 + i, "hot") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, k string")
    want = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}
    got = attach_key_counts(df, "k", "n")
    out = got.collect()
    assert len(out) == 700
    assert all(r["n"] == want[r["k"]] for r in out)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_keep_first_partition_invariant(spark):
    rows = [(i, f"k{(i * 7) % 13}", f"v{i}") for i in range(500)]
    base = spark.createDataFrame(rows, "row_id long, dedup_key string, v string")
    want = sorted(tuple(r) for r in keep_first(base).collect())
    for n in (1, 4, 17):
        shuffled = base.repartition(n, F.rand(7))
        assert sorted(tuple(r) for r in keep_first(shuffled).collect()) == want
    assert all(int(v[1:]) == rid for rid, _, v in want)
    assert {r[0] for r in want} == {min(i for i in range(500) if (i * 7) % 13 == k) for k in range(13)}


def test_keep_first_plan_has_no_window(spark):
    base = spark.createDataFrame([(1, "a", "x")], "row_id long, dedup_key string, v string")
    plan = keep_first(base)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan and "LeftSemi" in plan and "SortAggregate" not in plan


def test_template_columns(spark):
    flagged = identify(spark.createDataFrame(KEY_ROWS, SCHEMA))
    t = annotation_template(flagged, ["m1", "m2"], ["a1"])
    assert t.columns == ["row_id", "dedup_key", "title", "authors", "year", "doi", "source", "m1", "m2", "a1",
                         "Not Relevant", "Cancer Type"]
    assert t.count() == 7
    assert {tuple(r[7:]) for r in t.collect()} == {(0, 0, 0, 0, "")}
