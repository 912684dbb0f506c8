"""Null policy of the report tables (N7..N14) on every tag combination."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnow.operators import report as rep
from winnow.operators.screen import manual_screen, manual_screen_counts

L = ["m a", "m-b", "m c"]
VALUES = [0, 1, None, 2]


@pytest.fixture(scope="module")
def tags(spark):
    rows = []
    rid = 0
    for combo in itertools.product(VALUES, repeat=3):
        for nr in (0, 1, None):
            src = ["PubMed", "Scopus", "IEEE", "Other"][rid % 4]
            year = ["2020", "2021", "2022.0", "", None, "abc"][rid % 6]
            rows.append((rid, src, year, *combo, nr, ["Lung, Breast; Colon", " ", None, "Lung;;", ",Lung", " Lung "][rid % 6]))
            rid += 1
    schema = "row_id long, source string, year string, `m a` int, `m-b` int, `m c` int, `Not Relevant` int, `Cancer Type` string"
    return spark.createDataFrame(rows, schema)


def py_rows(df):
    return [r.asDict() for r in df.collect()]


def test_manual_screen_null_policy(spark, tags):
    got = {r["row_id"] for r in manual_screen(tags, L).collect()}
    want = {r["row_id"] for r in py_rows(tags)
            if any(r[l] == 1 for l in L) and r["Not Relevant"] != 1}
    assert got == want
    c = manual_screen_counts(tags, L).first()
    assert c["included"] == len(want) and c["included"] + c["excluded"] == c["total"] == tags.count()


def test_cooccurrence_raw_products(spark, tags):
    rows = py_rows(tags)
    got = {(r["row_label"], r["col_label"]): r["n"] for r in rep.cooccurrence(tags, L).collect()}
    for a in L:
        for b in L:
            want = sum((r[a] or 0) * (r[b] or 0) for r in rows)
            assert got[(a, b)] == want == got[(b, a)]


def test_method_application_counts_only_ones(spark, tags):
    rows = py_rows(tags)
    got = {(r["method"], r["application"]): r["n"] for r in rep.method_application_matrix(tags, L[:1], L[1:]).collect()}
    for b in L[1:]:
        assert got[(L[0], b)] == sum(1 for r in rows if r[L[0]] == 1 and r[b] == 1)


def test_category_counts_and_sources(spark, tags):
    rows = py_rows(tags)
    totals = {r["label"]: r["n"] for r in rep.category_counts(tags, L).collect()}
    assert totals == {l: sum(r[l] or 0 for r in rows) for l in L}
    by = rep.stack_offsets(rep.category_counts_by_source(tags, L)).collect()
    for l in L:
        seg = sorted((r for r in by if r["label"] == l), key=lambda r: r["source_ordinal"])
        assert [s["offset"] for s in seg] == [0, seg[0]["n"], seg[0]["n"] + seg[1]["n"]]
        assert seg[-1]["total"] == totals[l]
        assert seg[-1]["offset"] + seg[-1]["n"] == totals[l] - sum(r[l] or 0 for r in rows if r["source"] == "Other")
    dist = rep.distribution(tags, L).collect()
    assert all(r["n"] > 0 for r in dist)


def test_all_null_group_sums_to_zero(spark):
    df = spark.createDataFrame([(1, None, "2021"), (2, None, "2021")], "row_id long, `m a` int, year string")
    assert rep.category_counts(df, ["m a"]).first()["n"] == 0
    assert rep.temporal_trends(df, ["m a"]).first()["n"] == 0


def test_temporal_trends(spark, tags):
    rows = py_rows(tags)
    got = {(r["year"], r["label"]): r["n"] for r in rep.temporal_trends(tags, L).collect()}
    years = {2021, 2022}
    assert {y for y, _ in got} == years
    for y in years:
        for l in L:
            want = sum(r[l] or 0 for r in rows if r["year"] in (str(y), f"{y}.0"))
            assert got[(y, l)] == want


def test_venn_nulls_count_as_true(spark, tags):
    rows = py_rows(tags)
    regions = rep.venn_regions(tags, L).collect()
    assert len(regions) == 7
    truth = [tuple(True if r[l] is None else r[l] != 0 for l in L) for r in rows]
    for reg in regions:
        want = tuple(ch == "1" for ch in reg["region"])
        assert reg["n"] == sum(1 for t in truth if t == want)
    assert regions[0]["total"] == sum(1 for t in truth if any(t))
    with pytest.raises(ValueError):
        rep.venn_regions(tags, L[:2])


def test_any_label_null_is_false(spark, tags):
    rows = py_rows(tags)
    n = tags.agg(rep.any_label_count(tags, L)).first()[0]
    assert n == sum(1 for r in rows if any((r[l] or 0) != 0 for l in L))


def test_multi_value(spark, tags):
    rows = py_rows(tags)
    got = {r["value"]: r["n"] for r in rep.multi_value_counts(tags, "Cancer Type").collect()}
    want = {}
    import re
    for r in rows:
        c = r["Cancer Type"]
        if c is None or not c.strip():
            continue
        for piece in re.split(r"[,;]+", c.strip()):
            if piece.strip():
                want[piece.strip()] = want.get(piece.strip(), 0) + 1
    assert got == want
    cov = rep.value_coverage(tags, "Cancer Type").first()
    assert cov["n_rows"] == len(rows)
    assert cov["n_with_value"] == sum(1 for r in rows if r["Cancer Type"] and r["Cancer Type"].strip())
    assert rep.multi_value_counts(tags.drop("Cancer Type"), "Cancer Type").count() == 0


def test_missing_columns_raise(spark, tags):
    with pytest.raises(ValueError, match="missing"):
        rep.category_counts(tags, ["nope"])


def test_venn_of_eleven_labels(spark):
    labels = [f"l{i}" for i in range(11)]
    rows = [tuple(int((r * 37 + 11) >> i & 1) for i in range(11)) for r in range(300)]
    df = spark.createDataFrame(rows, ", ".join(f"{l} int" for l in labels))
    got = {r["region"]: (r["n"], r["total"]) for r in rep.venn_regions(df, labels, strict=False).collect()}
    want = {}
    for row in rows:
        want["".join(map(str, row))] = want.get("".join(map(str, row)), 0) + 1
    total = sum(n for k, n in want.items() if "1" in k)
    assert len(got) == 2**11 - 1 and all(got[k] == (want.get(k, 0), total) for k in got)


def test_summary_of_a_bare_table(spark):
    df = spark.createDataFrame([("k1", "PubMed"), ("k1", "IEEE"), ("k2", "Scopus")], "dedup_key string, source string")
    got = {r["metric"]: r["value"] for r in rep.identification_summary(df).collect()}
    assert got["total_raw"] == 3 and got["dedup_papers"] == 2 and got["duplicates_removed"] == 1 and got["kept"] == 2


def test_label_rank_carries_the_order_of_totals(spark, tags):
    order = [r["label"] for r in rep.category_counts(tags, L).collect()]
    by = {r["label"]: r["label_rank"] for r in rep.category_counts_by_source(tags, L).collect()}
    assert sorted(by, key=by.get) == order


def many_labels(spark, k, n=300, values=(0, 0, 0, 1, 1, None)):
    rng = random.Random(k)
    labels = [f"label {i}" for i in range(k)]
    rows = [tuple(rng.choice(values) for _ in labels) for _ in range(n)]
    fields = [T.StructField(l, T.IntegerType()) for l in labels]
    return labels, rows, spark.createDataFrame(rows, T.StructType(fields)).repartition(5)


def test_bitmaps_equal_pairs_at_200_labels(spark):
    labels, rows, df = many_labels(spark, 200, 120)
    dims = {"a": labels[:150], "b": labels[150:]}
    pairs = {tuple(r) for r in rep.cooccurrence(df, dims).collect()}
    assert {tuple(r) for r in rep.cooccurrence_bitmaps(df, dims).collect()} == pairs and len(pairs) == 150**2 + 50**2
    both = sum(1 for r in rows if r[0] == 1 and r[7] == 1)
    assert ("a", "label 0", "label 7", both) in pairs


def test_bitmaps_weigh_other_values(spark):
    labels, rows, df = many_labels(spark, 4, 400, (0, 1, 2, 5, -3, None, 2**20))
    want = {(a, b): sum((r[i] or 0) * (r[j] or 0) for r in rows) for i, a in enumerate(labels) for j, b in enumerate(labels)}
    for form in (rep.cooccurrence, rep.cooccurrence_bitmaps):
        assert {(r["row_label"], r["col_label"]): r["n"] for r in form(df, labels).collect()} == want
    empty = rep.cooccurrence_bitmaps(df.limit(0), labels).collect()
    assert len(empty) == 16 and {r["n"] for r in empty} == {0}


@pytest.mark.parametrize("form", [rep.cooccurrence, rep.cooccurrence_bitmaps])
def test_all_dimensions_in_one_scan(spark, tmp_path, form):
    labels, _, df = many_labels(spark, 6, 50)
    df.write.parquet(f"{tmp_path}/t")
    out = form(spark.read.parquet(f"{tmp_path}/t"), {"a": labels[:3], "b": labels[3:]})
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_regions_of_forty_labels(spark):
    labels, rows, df = many_labels(spark, 40, 200, (0,) * 12 + (1,))
    regions = collections.Counter("".join(str(int(bool(v))) for v in r) for r in rows)
    regions.pop("0" * 40, None)
    got = rep.venn_regions(df, labels, strict=False, occurring=True).collect()
    assert {r["region"]: r["n"] for r in got} == regions
    assert {r["total"] for r in got} == {sum(regions.values())}
    assert all(r["members"] == " & ".join(l for l, c in zip(labels, r["region"]) if c == "1") and r["n_labels"] == r["region"].count("1") for r in got)
    with pytest.raises(ValueError, match="occurring"):
        rep.venn_regions(df, labels, strict=False)


@pytest.mark.parametrize("k, order", [(11, None), (40, 3), (40, 1), (3, None)])
def test_inclusive_overlaps(spark, k, order):
    labels, rows, df = many_labels(spark, k, 150, (0,) * 9 + (1, 2, None)[: 2])
    want = collections.Counter()
    for r in rows:
        held = [i for i, v in enumerate(r) if v]
        for size in range(1, min(len(held), order or k) + 1):
            want.update(itertools.combinations(held, size))
    got = rep.inclusive_overlaps(df, labels, order).collect()
    assert {tuple(i for i, c in enumerate(r["region"]) if c == "1"): r["n"] for r in got} == want and len(got) == len(want)


def test_ordinals_of_all_regions(spark):
    labels, _, df = many_labels(spark, 9, 40)
    got = sorted(rep.venn_regions(df, labels, strict=False).collect())
    order = sorted((f"{m:09b}" for m in range(1, 512)), key=lambda r: (r.count("1"), r.translate(str.maketrans("01", "10"))))
    assert [(r["ordinal"], r["region"]) for r in got] == list(enumerate(order))


def test_counts_by_source_without_listed_rows(spark):
    df = spark.createDataFrame([(1, 2, "Other"), (1, None, None)], "x int, y int, source string")
    got = rep.category_counts_by_source(df, ["x", "y"]).collect()
    assert [(r["label"], r["label_rank"], r["total"], r["source"], r["n"]) for r in got] == [
        (l, i, 2, s, 0) for i, l in enumerate("xy") for s in rep.SOURCES]
    assert {(r["label"], r["source"], r["n"]) for r in rep.category_counts_by_source(df.drop("source"), ["x", "y"]).collect()} == {("x", None, 2), ("y", None, 2)}
    assert rep.category_counts_by_source(df.limit(0), ["x"]).count() == 3
