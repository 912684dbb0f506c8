"""CSV exports, adapters, ordered union with dense ids, stored tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from winnow.plans import workflow
from winnow.sources import exports, tables

PUBMED = ('﻿Title,Authors,Publication Year,DOI\n'
          '"A ""quoted"" title",Smith,2021,10.1/a\n'
          '"Two\nlines",Doe,NA,\n'
          'Plain,N/A,2020.0,null\n')
SCOPUS_NO_FULL = 'Title,Authors,Year,DOI\nS1,Lee,2019,10.1/A\nS2,Kim,nan,\n'
SCOPUS_FULL = 'Title,Author full names,Authors,Year,DOI\nS3,,Short,2018,\nS4,Long Name,Short,2018,None\n'
IEEE = 'Document Title,Title,Authors,Publication Year,DOI\nI1,ignored,Wu,2022,#N/A\n'


@pytest.fixture(scope="module")
def folder():
    d = tempfile.mkdtemp(prefix="winnow-src-")
    for name, text in [("pubmed.csv", PUBMED), ("scopus.csv", SCOPUS_NO_FULL), ("scopus_full.csv", SCOPUS_FULL),
                       ("ieee.csv", IEEE)]:
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    return d


def test_csv_quotes_newlines_bom_na(spark, folder):
    df = exports.read_export(spark, f"{folder}/pubmed.csv")
    assert df.columns == ["Title", "Authors", "Publication Year", "DOI"]
    rows = df.collect()
    assert [r["Title"] for r in rows] == ['A "quoted" title', "Two\nlines", "Plain"]
    assert rows[1]["Publication Year"] is None and rows[1]["DOI"] is None
    assert rows[2]["Authors"] is None and rows[2]["DOI"] is None


def test_column_fallback_is_per_column(spark, folder):
    no_full = exports.adapt_scopus(exports.read_export(spark, f"{folder}/scopus.csv"))
    assert [r["authors"] for r in no_full.collect()] == ["Lee", "Kim"]
    full = exports.adapt_scopus(exports.read_export(spark, f"{folder}/scopus_full.csv"))
    assert [r["authors"] for r in full.collect()] == [None, "Long Name"]   # null stays null (N3)
    ieee = exports.adapt_ieee(exports.read_export(spark, f"{folder}/ieee.csv"))
    assert ieee.first()["title"] == "I1"
    missing = exports.adapt_pubmed(spark.createDataFrame([("x",)], "Other string"))
    assert missing.first()["title"] == "" and missing.first()["doi"] == ""


def test_harmonise_order_and_dense_ids(spark, folder):
    rec = workflow.load_exports(spark, f"{folder}/pubmed.csv", f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    rows = rec.orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(6))
    assert [r["source"] for r in rows] == ["PubMed"] * 3 + ["Scopus"] * 2 + ["IEEE"]
    assert [r["title"] for r in rows][:3] == ['A "quoted" title', "Two\nlines", "Plain"]


def test_dense_ids_across_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumnRenamed("id", "v")
    out = exports.assign_row_ids(df, order_by=["v"]).collect()
    assert sorted(r["row_id"] for r in out) == list(range(1000))
    assert all(r["row_id"] == r["v"] for r in out)


def test_identification_checkpoint_and_tables(spark, folder):
    out = tempfile.mkdtemp(prefix="winnow-out-")
    args = (f"{folder}/pubmed.csv", f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    flagged = workflow.identification(spark, *args, out_dir=out, csv=True)
    assert flagged.count() == 6
    keys = {r["row_id"]: r["dedup_key"] for r in flagged.collect()}
    assert keys[0] == keys[3] == "10.1/a"          # PubMed DOI == Scopus DOI after lower-casing
    again = workflow.identification(spark, *args, out_dir=out)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, flagged.collect()))
    exported = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        f"{out}/flagged_csv")
    assert "Title" in exported.columns and "DOI_norm" in exported.columns and exported.count() == 6
    t = workflow.build_template(flagged, f"{out}/template", ["m1"], ["a1"])
    assert t.count() == flagged.select("dedup_key").distinct().count()


def test_resolve_first_and_stale_scores(spark, folder):
    assert tables.resolve_first(spark, f"{folder}/s*.csv", "none").endswith("scopus.csv")
    assert tables.resolve_first(spark, f"{folder}/zz*.csv", "none") == "none"
    out = tempfile.mkdtemp(prefix="winnow-scores-") + "/scores"
    tables.write_scores(spark.createDataFrame([(1, 0.5)], "row_id long, a double"), out)
    assert tables.read_scores(spark, out, ["a"]).count() == 1
    with pytest.raises(RuntimeError, match="Stale"):
        tables.read_scores(spark, out, ["a", "b"])
    with pytest.raises(Exception):
        tables.write_scores(spark.createDataFrame([(1, 0.5)], "row_id long, a double"), out)


def test_read_annotated_lenient_tags(spark):
    d = tempfile.mkdtemp(prefix="winnow-ann-")
    with open(f"{d}/ann.csv", "w", encoding="utf-8") as f:
        f.write("Title,m1,Not Relevant,Cancer Type\nA,1,0,Lung\nB,1.0,,\nC,x,1,\n")
    df = tables.read_annotated(spark, f"{d}/ann.csv", ["m1", "Not Relevant"])
    assert [(r["m1"], r["Not Relevant"]) for r in df.collect()] == [(1, 0), (1, None), (None, 1)]


def test_report_workflow_writes_every_table(spark):
    from conftest import SF_SMALL
    from winnow.operators.identify import identify
    from winnow.sources.fixture import annotated, raw_records
    out = tempfile.mkdtemp(prefix="winnow-report-")
    flagged = identify(raw_records(spark, SF_SMALL))
    res = workflow.report(annotated(spark, SF_SMALL), flagged, out_dir=tables.run_folder(out))
    assert {"prisma_flow", "venn_regions", "cooccurrence", "screened_export"} <= set(res)
    written = os.listdir(out)
    assert len(written) == 1 and written[0].startswith("run_")
    assert spark.read.parquet(f"{out}/{written[0]}/prisma_flow").count() == 18


def test_multi_file_exports_in_path_then_row_order(spark):
    d = tempfile.mkdtemp(prefix="winnow-multi-")
    names = ["b.csv", "a.csv", "c.csv"]
    sizes = [5, 40, 1]
    for name, n in zip(names, sizes):
        with open(f"{d}/{name}", "w", encoding="utf-8") as f:
            f.write("Title,Authors,Publication Year,DOI\n")
            for i in range(n):
                f.write(f"{name}-{i},x,2020,\n")
    empty = spark.createDataFrame([], "Title string")
    rec = exports.harmonise(exports.read_export(spark, [f"{d}/{n}" for n in names]), empty, empty)
    got = [r["title"] for r in rec.orderBy("row_id").collect()]
    want = [f"{n}-{i}" for n in sorted(names) for i in range(dict(zip(names, sizes))[n])]
    assert got == want
    assert sorted(r["row_id"] for r in rec.collect()) == list(range(sum(sizes)))


def test_command_line_two_phases(spark, folder):
    import glob

    from winnow.__main__ import main
    out = tempfile.mkdtemp(prefix="winnow-cli-")
    main(["identify", "--pubmed", f"{folder}/pubmed.csv", "--scopus", f"{folder}/scopus.csv",
          "--ieee", f"{folder}/ieee.csv", "--out", out, "--methods", "m1", "m2", "m3", "--applications", "a1"],
         spark=spark)
    template = glob.glob(f"{out}/template/*.csv")
    assert template
    t = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/template")
    assert {"Title", "m1", "Not Relevant", "Cancer Type", "dedup_key"} <= set(t.columns)
    # a person tags the template: emulate by writing an annotated copy
    ann = t.withColumn("m1", F.lit("1")).withColumn("Cancer Type", F.lit("Lung; Colon"))
    ann.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{out}/annotated")
    res = main(["report", "--annotated", f"{out}/annotated/*.csv", "--out", out,
                "--methods", "m1", "m2", "m3", "--applications", "a1"], spark=spark)
    assert {r["value"]: r["n"] for r in res["multi_value_counts"].collect()} == {"Lung": t.count(), "Colon": t.count()}
    assert res["prisma_flow"].filter("box = 'title_screen_passed'").first()["value"] == t.count()
    assert len(glob.glob(f"{out}/run_*/prisma_flow")) == 1
    split = res["category_counts_by_source"].filter("label = 'm1'").collect()
    assert {r["source"] for r in split} == {"PubMed", "Scopus", "IEEE"}
    assert sum(r["n"] for r in split) == t.count()


def test_read_or_build_rebuilds_for_new_inputs(spark):
    out = tempfile.mkdtemp(prefix="winnow-rob-") + "/t"
    calls = []

    def build(n):
        def f():
            calls.append(n)
            return spark.range(n)
        return f
    assert tables.read_or_build(spark, out, build(3), key=tables.fingerprint("a")).count() == 3
    assert tables.read_or_build(spark, out, build(5), key=tables.fingerprint("a")).count() == 3   # reused
    assert tables.read_or_build(spark, out, build(5), key=tables.fingerprint("b")).count() == 5   # new inputs
    assert calls == [3, 5]


def test_crlf_export(spark):
    d = tempfile.mkdtemp(prefix="winnow-crlf-")
    with open(f"{d}/x.csv", "w", encoding="utf-8", newline="") as f:
        f.write('Title,Authors,Publication Year,DOI\r\n"A\r\nB",X,2020,10.1/a\r\nC,Y,NA,10.1/b\r\n')
    rows = exports.read_export(spark, f"{d}/x.csv").collect()
    assert [r["DOI"] for r in rows] == ["10.1/a", "10.1/b"]
    assert rows[0]["Title"] in ("A\r\nB", "A\nB") and rows[1]["Publication Year"] is None


def test_join_annotations_by_key(spark):
    template = spark.createDataFrame([("k1", "T1", 0, 0), ("k2", "T2", 0, 0), ("k3", "T3", 0, 0)],
                                     "dedup_key string, title string, m1 int, `Not Relevant` int")
    ann = spark.createDataFrame([("k1", 1, 0, "Lung"), ("k3", None, 1, None)],
                                "dedup_key string, m1 int, `Not Relevant` int, `Cancer Type` string")
    out = {r["dedup_key"]: r for r in workflow.join_annotations(template, ann, ["m1"]).collect()}
    assert out["k1"]["m1"] == 1 and out["k1"]["Cancer Type"] == "Lung"
    assert out["k2"]["m1"] is None and out["k3"]["Not Relevant"] == 1
    assert set(out["k1"].asDict()) == {"dedup_key", "title", "m1", "Not Relevant", "Cancer Type"}


def test_csv_path_agrees_with_registered_query(spark):
    """Records written as three vendor CSV exports and identified through the
    CSV path give the same summary and keys as the registered query."""
    from conftest import SF_MID
    from winnow.operators import identify as ident
    from winnow.operators import report
    from winnow.plans.catalog import QUERIES
    from winnow.sources.fixture import raw_records
    d = tempfile.mkdtemp(prefix="winnow-e2e-")
    pub, sco, iee = exports.split_by_source(raw_records(spark, SF_MID))
    for name, df in (("pubmed", pub), ("scopus", sco), ("ieee", iee)):
        (df.orderBy("row_id").drop("row_id").coalesce(1).write.option("header", True).option("escape", '"')
         .csv(f"{d}/{name}"))
    flagged = workflow.identification(spark, f"{d}/pubmed", f"{d}/scopus", f"{d}/ieee", out_dir=f"{d}/out")
    got = {r["metric"]: r["value"] for r in report.identification_summary(flagged).collect()}
    want = {r["metric"]: r["value"] for r in QUERIES["identification_summary"](spark, SF_MID).collect()}
    assert got == want
    keys_csv = sorted(r["dedup_key"] for r in flagged.collect() if not r["dedup_key"].startswith("ROW:"))
    keys_q = sorted(r["dedup_key"] for r in ident.keyed(raw_records(spark, SF_MID)).collect()
                    if not r["dedup_key"].startswith("ROW:"))
    assert keys_csv == keys_q


def test_flagged_csv_round_trip(spark, folder):
    from winnow.operators import report
    out = tempfile.mkdtemp(prefix="winnow-fcsv-")
    args = (f"{folder}/pubmed.csv", f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    flagged = workflow.identification(spark, *args, out_dir=out, csv=True)
    back = tables.read_flagged_csv(spark, f"{out}/flagged_csv")
    assert dict(back.dtypes)["flag_review_conf"] == "boolean" and dict(back.dtypes)["dup_group_size"] == "bigint"
    a = {r["metric"]: r["value"] for r in report.identification_summary(flagged).collect()}
    b = {r["metric"]: r["value"] for r in report.identification_summary(back).collect()}
    assert a == b
    assert report.qa_missing(flagged).collect() == report.qa_missing(back).collect()


def test_flagged_csv_keeps_keep_first_order(spark, folder):
    from winnow.operators.screen import survivors
    out = tempfile.mkdtemp(prefix="winnow-fcsv2-")
    args = (f"{folder}/pubmed.csv", f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    flagged = workflow.identification(spark, *args, out_dir=out, csv=True)
    back = tables.read_flagged_csv(spark, f"{out}/flagged_csv")
    assert dict(back.dtypes)["row_id"] == "bigint"
    a = sorted(r["row_id"] for r in survivors(flagged).collect())
    b = sorted(r["row_id"] for r in survivors(back).collect())
    assert a == b


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_files_with_other_column_order(spark, tmp_path):
    a, b = f"{tmp_path}/in/a.csv", f"{tmp_path}/in/b.csv"
    _write(a, "Title,Authors,Publication Year,DOI\nT1,A1,2020,10.1/a\n")
    _write(b, "DOI,Title,Authors,Publication Year\n10.1/b,T2,A2,2021\n")
    rows = exports.adapt_pubmed(exports.read_export(spark, [a, b])).orderBy("title").collect()
    assert [(r["title"], r["authors"], r["doi"]) for r in rows] == [("T1", "A1", "10.1/a"), ("T2", "A2", "10.1/b")]
    with pytest.raises(Exception, match="(?i)header|schema"):
        exports.read_export(spark, f"{tmp_path}/in").collect()


def test_surplus_cell_is_an_error_and_short_rows_are_not(spark, tmp_path):
    _write(f"{tmp_path}/x/s.csv", 'Title,Authors,DOI\nT1,A1\n"T,2",A2,10.1/b\n')
    got = exports.read_export(spark, f"{tmp_path}/x/s.csv").collect()
    assert [(r["Title"], r["DOI"]) for r in got] == [("T1", None), ("T,2", "10.1/b")]
    _write(f"{tmp_path}/x/l.csv", "Title,Authors,DOI\nT1,A1,10.1/a,EXTRA\n")
    with pytest.raises(Exception, match="more than 3 cells"):
        exports.read_export(spark, f"{tmp_path}/x/l.csv").collect()


def test_part_file_folder_is_one_match(spark, tmp_path):
    df = spark.range(100).selectExpr("id as row_id", "cast(id as string) as Title", "'1' as m1")
    df.repartition(4).write.option("header", True).csv(f"{tmp_path}/annotated_x")
    path = tables.resolve_first(spark, f"{tmp_path}/annotated*", "none")
    assert tables.read_annotated(spark, path, ["m1"]).count() == 100


def test_tags_keep_fractions_and_reject_suffixes(spark, tmp_path):
    _write(f"{tmp_path}/t.csv", "Title,m1\nA,1.7\nB,0.5\nC,2021d\nD,2022f\nE,1e0\nF, 1 \nG,.5\n")
    got = {r["title"]: r["m1"] for r in tables.read_annotated(spark, f"{tmp_path}/t.csv", ["m1"]).collect()}
    assert got == {"A": 1.7, "B": 0.5, "C": None, "D": None, "E": 1.0, "F": 1.0, "G": 0.5}


def test_changed_inputs_rebuild(spark, folder, tmp_path):
    src = f"{tmp_path}/p.csv"
    _write(src, PUBMED)
    args = (src, f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    assert workflow.identification(spark, *args, out_dir=str(tmp_path)).count() == 6
    _write(src, PUBMED + "More,B,2019,10.1/z\n")
    assert workflow.identification(spark, *args, out_dir=str(tmp_path)).count() == 7
    with pytest.raises(Exception):
        _write(f"{tmp_path}/bad/x.parquet", "no parquet")
        tables.table_exists(spark, f"{tmp_path}/bad")


def test_score_and_validation_jobs(spark, tmp_path):
    from winnow.operators import score
    from winnow.operators.identify import identify
    from winnow.plans.catalog import LEX_APPLICATIONS, LEX_METHODS
    from winnow.sources.fixture import raw_records
    from conftest import SF_SMALL
    flagged, out, calls = identify(raw_records(spark, SF_SMALL)), str(tmp_path), []

    def scorer(candidates, labels):
        calls.append(labels)
        return score.with_lexical_scores(candidates, "title", labels).select("row_id", "scores")

    rows = workflow.score_screen(flagged, scorer, out, LEX_METHODS, LEX_APPLICATIONS)["merged_tags"].count()
    again = workflow.score_screen(flagged, scorer, out, LEX_METHODS, LEX_APPLICATIONS)
    assert len(calls) == 1 and rows == again["merged_tags"].count() > 0
    c = again["screen_counts"].first()
    assert c["included"] + c["excluded"] == c["total"] == again["merged_tags"].count() and again["screened"].count() == c["included"]
    with pytest.raises(RuntimeError, match="Stale"):
        workflow.score_screen(flagged, scorer, out, [*LEX_METHODS, "new label"], LEX_APPLICATIONS)
    sheets = workflow.validation(again["merged_tags"], out, LEX_METHODS, low=0.6)
    for name, df in sheets.items():
        rows = df.collect()
        keys = [(-r["max_score"], r["row_id"]) for r in rows]
        assert keys == sorted(keys) and {"Your_Decision", "Notes"} <= set(df.columns)
        assert all((r["max_score"] >= 0.6) == (name == "borderline_sheet") for r in rows)
        assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{out}/{name}").count() == len(rows)


def test_rows_are_numbered_without_a_sort_of_all(spark):
    rows = [(i * 7919 % 100_003, i % 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "o long, s int").repartition(5)
    got = {(r["s"], r["o"]): r["row_id"] for r in exports.number_rows(df, "s", "o").collect()}
    assert [got[k] for k in sorted(got)] == list(range(5000))


def test_exports_carry_a_byte_order_mark(spark, folder, tmp_path):
    df = spark.createDataFrame([(i, f"Tïtle {i}") for i in range(6)], "row_id long, title string").repartition(3)
    tables.write_csv(df, f"{tmp_path}/marked")
    tables.write_csv(df, f"{tmp_path}/plain", mark=False)
    for name, start in (("marked", b"\xef\xbb\xbfrow_id,Title\n"), ("plain", b"row_id,Title\n")):
        parts = [p for p in os.listdir(f"{tmp_path}/{name}") if p.endswith(".csv")]
        assert len(parts) >= 3 and all(open(f"{tmp_path}/{name}/{p}", "rb").read().startswith(start) for p in parts)
        back = tables.read_flagged_csv(spark, f"{tmp_path}/{name}")
        assert back.columns == ["row_id", "title"] and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_rows_with_surplus_cells_are_set_aside(spark, folder, tmp_path):
    _write(f"{tmp_path}/q/a.csv", 'Title,Authors,Publication Year,DOI\nT1,A1,2020,10.1/a,EXTRA\nT2,A2\n"T\n3",A3,2021,10.1/c\n')
    _write(f"{tmp_path}/q/b.csv", 'Title,Authors,Publication Year,DOI\nT4,A4,2020,10.1/d\n"T,5",A5,2020,10.1/e,"x,y",z\n')
    good, bad = exports.read_export_parts(spark, f"{tmp_path}/q")
    assert sorted(r["Title"] for r in good.collect()) == ["T\n3", "T2", "T4"]
    rows = sorted((r["file"].rsplit("/", 1)[1], r["cells"], r["text"]) for r in bad.collect())
    assert rows == [("a.csv", 4, "T1,A1,2020,10.1/a,EXTRA"), ("b.csv", 4, '"T,5",A5,2020,10.1/e,"x,y",z')]
    args = (f"{tmp_path}/q", f"{folder}/scopus.csv", f"{folder}/ieee.csv")
    flagged = workflow.identification(spark, *args, out_dir=f"{tmp_path}/out", quarantine=True)
    aside = spark.read.parquet(f"{tmp_path}/out/quarantine").collect()
    assert flagged.filter("source = 'PubMed'").count() == 3 and [r["source"] for r in aside] == ["PubMed"] * 2
    with pytest.raises(Exception, match="more than 4 cells"):
        workflow.identification(spark, *args, out_dir=f"{tmp_path}/strict")


def test_a_failed_write_is_built_again(spark, tmp_path):
    os.makedirs(f"{tmp_path}/t/fp=a/_temporary")
    assert tables.read_or_build(spark, f"{tmp_path}/t", lambda: spark.range(3), key="a").count() == 3
