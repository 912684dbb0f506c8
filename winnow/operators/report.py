"""Count tables of the screening report (AGG-1..18, WIN-3).

Every aggregate is algebraic, so Spark runs a partial (map-side) aggregate
before any exchange. Key-level metrics go through one ``groupBy(dedup_key)``
(rows -> keys) and a global aggregate over keys; nothing is collected. Tables
come out in long form ``(label, n)`` / ``(row_label, col_label, n)`` so the
number of labels is a parameter, not a schema.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import SOURCES, TREND_MIN_YEAR
from ..functions.nulls import any_nonzero, count_if, fill0_int, is_one, lenient_int, nonblank, sum0, truthy
from ..functions.text import split_multi_value
from .skew import key_digest


def lc(name: str) -> Column:
    """A column by its exact name (labels contain spaces and dashes)."""
    return F.col(f"`{name}`")


def require(df: DataFrame, cols: Sequence[str], what: str = "Columns") -> None:
    """VAL-1: raise listing the missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} missing from DataFrame: {missing}")


Labels = Sequence[str] | dict[str, Sequence[str]]


def _groups(labels: Labels) -> list[tuple[str | None, list[str]]]:
    """A plain label list is one unnamed group; a dict maps a dimension name
    (methods, applications, ...) to its labels, so every dimension is computed
    in the same aggregate pass."""
    if isinstance(labels, dict):
        return [(d, list(ls)) for d, ls in labels.items()]
    return [(None, list(labels))]


def _all_labels(labels: Labels) -> list[str]:
    return list(dict.fromkeys(l for _, ls in _groups(labels) for l in ls))


def _dim(d: str | None) -> list[Column]:
    return [] if d is None else [F.lit(d).alias("dimension")]


def _sorted_small(df: DataFrame, *cols) -> DataFrame:
    """Total order for a table that is small by construction (labels, years,
    sources, category values), without the sampling job of a global
    ``orderBy``. ``repartition(1)``, not ``coalesce(1)``: a coalesce is narrow
    and would pull the final aggregate (partial rows of every map task) into
    one task; the exchange keeps that aggregate parallel and moves only its
    small output."""
    return df.repartition(1).sortWithinPartitions(*cols)


def _long(row: DataFrame, entries: list[Column]) -> DataFrame:
    """One aggregated row -> many rows (``inline`` of an array of structs)."""
    return row.select(F.inline(F.array(*entries)))


# ---------------------------------------------------------------------------
# Identification metrics
# ---------------------------------------------------------------------------

SUMMARY_METRICS = ("pubmed", "scopus", "ieee", "total_raw", "duplicates_removed", "dedup_papers",
                   "excluded_rev_conf", "kept")


def key_level(keyed: DataFrame, key: str = "dedup_key", extra: Sequence[Column] = ()) -> DataFrame:
    """Rows -> one row per key (by digest): size, any flag, per-source
    counts and ``extra`` aggregates. The only exchange of the identification
    metrics; a table of key and source is enough."""
    mark = F.col("flag_review_conf") if "flag_review_conf" in keyed.columns else F.lit(False)
    return keyed.groupBy(key_digest(key).alias("_kd")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(mark.cast("int")).alias("any_flagged"),
        F.min(mark.cast("int")).alias("all_flagged"),
        *[count_if(F.col("source") == s).alias(f"n_{s.lower()}") for s in SOURCES],
        *extra,
    )


def _summary_row(keyed: DataFrame) -> DataFrame:
    return key_level(keyed).agg(
        *[F.coalesce(F.sum(f"n_{s.lower()}"), F.lit(0)).alias(s.lower()) for s in SOURCES],
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_raw"),
        F.count(F.lit(1)).alias("dedup_papers"),
        count_if(F.col("any_flagged") == 1).alias("excluded_rev_conf"),
        count_if(F.col("all_flagged") == 0).alias("template_rows"),
    ).withColumns({
        "duplicates_removed": F.col("total_raw") - F.col("dedup_papers"),
        "kept": F.col("dedup_papers") - F.col("excluded_rev_conf"),
    })


def identification_summary(keyed: DataFrame) -> DataFrame:
    """AGG-7 (AGG-1..4): the eight identification counts as
    ``(ordinal, metric, value)``. ``excluded`` is 0 without a flag column."""
    require(keyed, ["dedup_key", "source"], "dedup_key is missing; columns")
    row = _summary_row(keyed)
    return _long(row, [
        F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("metric"), F.col(m).cast("long").alias("value"))
        for i, m in enumerate(SUMMARY_METRICS)
    ])


def qa_missing(keyed: DataFrame) -> DataFrame:
    """AGG-5: missing DOI / title / year and rows in duplicate groups, one row."""
    blanks = {"missing_doi": "doi_norm", "missing_title": "title_norm", "missing_year": "year"}
    keys = key_level(keyed, extra=[count_if(F.col(c) == "").alias(name) for name, c in blanks.items()])
    return keys.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in blanks],
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("duplicate_rows"))


def source_counts(df: DataFrame) -> DataFrame:
    """AGG-1 / AGG-6: rows per source, largest first."""
    return _sorted_small(df.groupBy("source").agg(F.count(F.lit(1)).alias("n")),
                         F.desc("n"), F.asc_nulls_last("source"))


# ---------------------------------------------------------------------------
# Label tables
# ---------------------------------------------------------------------------

def _tags(groups: list[tuple[str | None, list[str]]]) -> Column:
    """Array of a row's nonzero tags, (dimension number, label number, value)."""
    entries = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(i).alias("i"), fill0_int(lc(l)).alias("v"))
                        for g, (_, ls) in enumerate(groups) for i, l in enumerate(ls)])
    return F.filter(entries, lambda e: e["v"] != 0)


def _label_grid(spark: SparkSession, groups: list[tuple[str | None, list[str]]], counted: DataFrame) -> DataFrame:
    """Every (row, col) pair of each label list with its count ``n`` of
    ``counted`` (g, i, j, n), zero when absent. The grid is generated in Spark
    from the label literals (two explodes) and joined by key - neither a cross
    join nor labels^2 rows from the driver."""
    lists = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(d).cast("string").alias("dimension"), F.array(*[F.lit(l) for l in ls]).alias("ls"))
                      for g, (d, ls) in enumerate(groups)])
    grid = (spark.range(1).select(F.inline(lists)).select("*", F.posexplode("ls").alias("i", "row_label"))
            .select("*", F.posexplode("ls").alias("j", "col_label")))
    dims = [] if groups[0][0] is None else ["dimension"]
    return (grid.join(counted, ["g", "i", "j"], "left")
            .select(*dims, "row_label", "col_label", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def cooccurrence(df: DataFrame, labels: Labels) -> DataFrame:
    """AGG-8: ``B^T B`` over ``fillna(0).astype(int)`` tags, as
    ``([dimension,] row_label, col_label, n)``; symmetric, diagonal = sum of
    squares. Each row pairs only its own nonzero labels of a dimension, the pairs
    of all dimensions are counted in one scan with one ``groupBy`` (partial
    aggregation), and pairs that never co-occur are filled with 0 from the label
    list. The work is that of the pairs that rows hold; for rows with many tags
    see ``cooccurrence_bitmaps``."""
    require(df, _all_labels(labels), "Theme columns")
    groups = _groups(labels)
    pairs = F.flatten(F.transform("_tags", lambda a: F.transform(
        F.filter("_tags", lambda b: b["g"] == a["g"]),
        lambda b: F.struct(a["g"].alias("g"), a["i"].alias("i"), b["i"].alias("j"), (a["v"].cast("long") * b["v"]).alias("p")))))
    counted = (df.select(_tags(groups).alias("_tags")).select(F.inline(pairs))
               .groupBy("g", "i", "j").agg(F.sum("p").cast("long").alias("n")))
    return _label_grid(df.sparkSession, groups, counted)


INT_BITS = 32  # of a tag's value


def cooccurrence_bitmaps(df: DataFrame, labels: Labels) -> DataFrame:
    """AGG-8 for many labels and rows with many tags: the same table from bitmaps.

    Rows are numbered and dealt to buckets of 32,768; each label has one bitmap a
    bucket, built by partial aggregation in the one scan of all dimensions. In a
    bucket the bitmaps of every two labels are intersected and counted where they
    are, so the number of pairs depends on the labels, not on the rows' tags, and
    only counts travel. A value other than 0 and 1 has a bitmap for each bit of
    its two's complement; bits p and q of a pair weigh 2^p 2^q."""
    require(df, _all_labels(labels), "Theme columns")
    groups = _groups(labels)
    bits = F.flatten(F.transform("_tags", lambda e: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(INT_BITS - 1)), lambda p: F.getbit(e["v"], p) == 1),
        lambda p: F.struct(e["g"].alias("g"), e["i"].alias("i"), p.alias("p")))))
    rows = df.select(F.monotonically_increasing_id().alias("_id"), _tags(groups).alias("_tags"))
    maps = (rows.select("_id", F.inline(bits))
            .groupBy("g", "i", "p", F.bitmap_bucket_number("_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("m")))
    # one row a bucket and dimension holds at most 32 bitmaps of 4 KB a label
    one = maps.groupBy("g", "bucket").agg(F.array_sort(F.collect_list(F.struct("i", "p", "m"))).alias("ms"))
    two = F.transform("ms", lambda a: F.transform(F.filter("ms", lambda b: (b["i"] > a["i"]) | ((b["i"] == a["i"]) & (b["p"] >= a["p"]))),
                                                  lambda b: F.struct(a["i"].alias("i"), a["p"].alias("p"), b["i"].alias("j"), b["p"].alias("q"),
                                                                     F.array(a["m"], b["m"]).alias("pair"))))
    pairs = one.select("g", "bucket", F.explode(two).alias("_of")).select("g", "bucket", F.inline("_of"))
    met = (pairs.select("g", "bucket", "i", "p", "j", "q", F.explode("pair").alias("m"))
           .groupBy("g", "bucket", "i", "p", "j", "q").agg(F.bitmap_count(F.bitmap_and_agg("m")).alias("c")))

    def weight(p: str) -> Column:
        return F.when(F.col(p) == INT_BITS - 1, F.lit(-1)).otherwise(F.lit(1)) * F.expr(f"shiftleft(1L, {p})")

    once = (F.col("i") != F.col("j")) | (F.col("p") == F.col("q"))  # two bits of one label stand for (p, q) and (q, p)
    share = F.col("c").cast("decimal(19,0)") * (weight("p") * weight("q")) * F.when(once, 1).otherwise(2)  # parts may exceed a long
    half = met.groupBy("g", "i", "j").agg(F.sum(share).cast("long").alias("n"))
    both = half.select("g", F.inline(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j", "n"))).otherwise(
        F.array(F.struct("i", "j", "n"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), F.col("n"))))))
    return _label_grid(df.sparkSession, groups, both)


def method_application_matrix(df: DataFrame, methods: Sequence[str], applications: Sequence[str],
                              short: dict[str, str] | None = None) -> DataFrame:
    """AGG-9: papers with method = 1 AND application = 1 (a 2 is not counted),
    ``(method, application, method_short, application_short, n)``, one pass.
    ``short`` maps labels to display names (PRJ-4); others keep their own."""
    short = short or {}
    require(df, [*methods, *applications])
    cells = [(m, a) for m in methods for a in applications]
    row = df.agg(*[count_if(is_one(lc(m)) & is_one(lc(a))).alias(f"_c{i}") for i, (m, a) in enumerate(cells)])
    return _long(row, [
        F.struct(F.lit(m).alias("method"), F.lit(a).alias("application"),
                 F.lit(short.get(m, m)).alias("method_short"), F.lit(short.get(a, a)).alias("application_short"),
                 F.col(f"_c{i}").cast("long").alias("n"))
        for i, (m, a) in enumerate(cells)
    ])


def temporal_trends(df: DataFrame, labels: Sequence[str], year_col: str = "year",
                    min_year: int = TREND_MIN_YEAR) -> DataFrame:
    """AGG-10: yearly label sums for years >= ``min_year`` (lenient numeric
    year, truncated), ``(year, label, n)``; absent years stay absent."""
    require(df, labels)
    y = lenient_int(lc(year_col))
    yearly = (df.filter(y >= min_year)  # a null year fails the comparison (dropna)
              .groupBy(y.alias("year"))
              .agg(*[sum0(lc(l)).alias(f"_s{i}") for i, l in enumerate(labels)]))
    return _sorted_small(yearly.select("year", F.inline(F.array(*[
        F.struct(F.lit(l).alias("label"), F.col(f"_s{i}").alias("n")) for i, l in enumerate(labels)]))),
        "year", "label")


def category_counts(df: DataFrame, labels: Labels) -> DataFrame:
    """AGG-11: label totals (nulls skipped), ascending, ``([dimension,] label, n)``."""
    require(df, _all_labels(labels), "Label columns")
    pairs = [(d, l) for d, ls in _groups(labels) for l in ls]
    row = df.agg(*[sum0(lc(l)).alias(f"_s{i}") for i, (_, l) in enumerate(pairs)])
    out = _long(row, [F.struct(*_dim(d), F.lit(l).alias("label"), F.col(f"_s{i}").alias("n"))
                      for i, (d, l) in enumerate(pairs)])
    return _sorted_small(out, *(["dimension"] if isinstance(labels, dict) else []), "n", "label")


def category_counts_by_source(df: DataFrame, labels: Labels, sources: Sequence[str] = SOURCES) -> DataFrame:
    """AGG-12: per label and listed source, ``([dimension,] label, label_rank,
    total, source, source_ordinal, n)``; ``label_rank`` is the label's place in
    the AGG-11 order (ascending total, then label). Unlisted sources count in
    ``total`` only. Without a source column: one row per label with a null
    source and n = total."""
    require(df, _all_labels(labels), "Label columns")
    groups = _groups(labels)
    names = [(g, d, l) for g, (d, ls) in enumerate(groups) for l in ls]
    known = "source" in df.columns
    ordinal = F.coalesce(*[F.when(F.col("source") == s, F.lit(j)) for j, s in enumerate(sources)]) if known and sources else F.lit(None).cast("int")
    # one row for each listed source and one for all others; then one row of them
    by = df.groupBy(ordinal.alias("_o")).agg(F.array(*[sum0(lc(l)) for _, _, l in names]).alias("_n"))
    row = by.agg(F.collect_list(F.struct("_o", "_n")).alias("_by"))

    def count(i: int, j: int | None) -> Column:
        """Sum of label ``i`` in source ``j``, or in all rows."""
        return F.aggregate("_by", F.lit(0).cast("long"), lambda a, x: a + (
            x["_n"][i] if j is None else F.when(x["_o"] == j, x["_n"][i]).otherwise(F.lit(0))))

    row = row.select("_by", *[count(i, None).alias(f"_t{i}") for i in range(len(names))])
    places = [F.array_sort(F.array(*[F.struct(F.col(f"_t{i}").alias("t"), F.lit(l).alias("l")) for i, (h, _, l) in enumerate(names) if h == g])).alias(f"_r{g}")
              for g in range(len(groups))]
    listed = list(enumerate(sources)) if known else [(None, None)]

    out = _long(row.select("*", *places), [
        F.struct(*_dim(d), F.lit(l).alias("label"),
                 (F.array_position(f"_r{g}", F.struct(F.col(f"_t{i}").alias("t"), F.lit(l).alias("l"))) - 1).cast("int").alias("label_rank"),
                 F.col(f"_t{i}").alias("total"), F.lit(s).cast("string").alias("source"), F.lit(j).cast("int").alias("source_ordinal"),
                 count(i, j).alias("n"))
        for i, (g, d, l) in enumerate(names) for j, s in listed
    ])
    return _sorted_small(out, *(["dimension"] if isinstance(labels, dict) else []), "label_rank", "source_ordinal")


def stack_offsets(by_source: DataFrame) -> DataFrame:
    """WIN-3: start of each source segment inside its label's stacked bar
    (running sum of the earlier sources). Runs on the small AGG-12 table."""
    part = ["dimension", "label"] if "dimension" in by_source.columns else ["label"]
    w = Window.partitionBy(*part).orderBy("source_ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return by_source.withColumn("offset", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long"))


def distribution(df: DataFrame, labels: Labels) -> DataFrame:
    """AGG-13: label totals above zero, largest first."""
    dims = ["dimension"] if isinstance(labels, dict) else []
    return _sorted_small(category_counts(df, labels).filter(F.col("n") > 0), *dims, F.desc("n"), "label")


def any_label_count(df: DataFrame, labels: Sequence[str]) -> Column:
    """AGG-14 as an aggregate expression: rows with any label != 0 (null = False)."""
    return count_if(any_nonzero([lc(l) for l in labels]))


def any_label_counts(df: DataFrame, labels: Labels) -> DataFrame:
    """AGG-14 per label group in one pass, ``([dimension,] n)``."""
    groups = _groups(labels)
    require(df, _all_labels(labels))
    row = df.agg(*[any_label_count(df, ls).cast("long").alias(f"_a{g}") for g, (_, ls) in enumerate(groups)])
    return _long(row, [F.struct(*_dim(d), F.col(f"_a{g}").alias("n")) for g, (d, _) in enumerate(groups)])


def _region(labels: Sequence[str], null_as_true: bool) -> Column:
    """A row's region: one 0/1 character a label, in label order."""
    return F.concat(*[F.when(truthy(lc(l), null_as_true), "1").otherwise("0") for l in labels])


def _members(region: Column, labels: Sequence[str]) -> Column:
    names = F.array(*[F.lit(l) for l in labels])
    return F.array_join(F.filter(names, lambda l, i: F.substring(region, i + 1, F.lit(1)) == "1"), " & ")


LISTED_LABELS = 24  # of more labels the regions are too many to list


def venn_regions(df: DataFrame, labels: Sequence[str], null_as_true: bool = True, strict: bool = True,
                 occurring: bool = False) -> DataFrame:
    """AGG-15: the 2^k - 1 exclusive overlap regions of k labels under
    ``astype(bool)`` (null counts as True). ``region`` is a 0/1 string in label
    order, ``members`` the included labels; ``total`` excludes rows in no
    label. ``strict`` keeps the three-label contract.

    Rows are counted by their region (partial aggregation). The list of all
    regions is generated as rows, one each, and joined with the counts; a
    region's ``ordinal`` (number of labels, then label order) is computed from
    its own bits, so nothing is sorted. With ``occurring`` only the regions that
    some row is in are given, for any number of labels: ``(n_labels, region,
    members, n, total)``."""
    if strict and len(labels) != 3:
        raise ValueError(f"three labels are needed, not {len(labels)}; pass strict=False for another number")
    if len(labels) > LISTED_LABELS and not occurring:
        raise ValueError(f"{len(labels)} labels have 2^{len(labels)} - 1 regions; pass occurring=True for those that occur")
    require(df, labels)
    k = len(labels)
    counted = df.groupBy(_region(labels, null_as_true).alias("region")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.filter(F.col("region").contains("1"))
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total")).scalar()
    if occurring:
        return counted.select(F.length(F.replace("region", F.lit("0"), F.lit(""))).alias("n_labels"), "region",
                              _members(F.col("region"), labels).alias("members"), F.col("_n").cast("long").alias("n"), total.alias("total"))
    listed = df.sparkSession.range(1, 1 << k).select(F.reverse(F.lpad(F.bin("id"), k, "0")).alias("region"), F.bit_count("id").alias("_b"), "id")
    # regions with fewer labels come first; among equals, those whose first difference is a 1
    ahead = F.element_at(F.array(*[F.lit(sum(math.comb(k, c) for c in range(1, b))).cast("long") for b in range(1, k + 1)]), F.col("_b"))
    for i in range(k):
        before = F.bit_count(F.col("id").bitwiseAND(F.lit((1 << i) - 1)))
        skipped = F.array(*[F.lit(math.comb(k - 1 - i, r - 1) if r else 0).cast("long") for r in range(k + 1)])
        ahead = ahead + F.when(F.getbit("id", F.lit(i)) == 0, F.element_at(skipped, F.col("_b") - before + 1)).otherwise(F.lit(0))
    return listed.join(counted, "region", "left").select(
        ahead.cast("int").alias("ordinal"), "region", _members(F.col("region"), labels).alias("members"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n"), total.alias("total"))


LATTICE_LABELS = 8  # labels that one step of the lattice transform folds


def inclusive_overlaps(df: DataFrame, labels: Sequence[str], order: int | None = None, null_as_true: bool = True) -> DataFrame:
    """AGG-15, inclusive: rows that have *at least* the labels of a set, for every
    set of up to ``order`` labels (all sizes by default) with such a row:
    ``(n_labels, region, members, n)``. Any number of labels.

    The sums run up the lattice of label sets: in steps of ``LATTICE_LABELS``
    labels, each region hands its count to itself and to every region with some
    of these labels taken out, and equal regions are added before the next step
    (partial aggregation). Sets with more than ``order`` labels in the folded part
    leave at once, so the tables stay near the number of answers."""
    require(df, labels)
    k = len(labels)
    top = k if order is None else order
    now = df.groupBy(_region(labels, null_as_true).alias("region")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("region").contains("1"))
    for start in range(0, k, LATTICE_LABELS):
        width = min(LATTICE_LABELS, k - start)
        block = F.conv(F.substring("region", start + 1, width), 2, 10).cast("int")
        below = F.filter(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: m.bitwiseAND(F.col("_block")) == m)
        parts = now.withColumn("_block", block).select("region", "n", F.explode(below).alias("_m"))
        folded = F.concat(F.substring("region", 1, start), F.lpad(F.bin("_m"), width, "0"))
        ones = F.length(F.replace(folded, F.lit("0"), F.lit("")))
        now = (parts.filter(ones <= top).groupBy(F.concat(folded, F.substring("region", start + width + 1, k)).alias("region"))
               .agg(F.sum("n").alias("n")))
    now = now.filter(F.col("region").contains("1"))
    return now.select(F.length(F.replace("region", F.lit("0"), F.lit(""))).alias("n_labels"), "region",
                      _members(F.col("region"), labels).alias("members"), "n")


def multi_value_counts(df: DataFrame, column: str) -> DataFrame:
    """AGG-17 / TXT-8: split multi-value cells on runs of ``,`` / ``;``, strip,
    drop blanks, count per value (case-sensitive), ascending. A missing column
    gives an empty table (VAL-3)."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], "value string, n long")
    cell = lc(column).cast("string")
    values = (df.filter(nonblank(cell))
              .select(F.explode(split_multi_value(cell)).alias("value"))
              .filter(F.col("value") != ""))
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "value")


def value_coverage(df: DataFrame, column: str) -> DataFrame:
    """AGG-18: rows with a non-blank value, of all rows."""
    cell = lc(column).cast("string") if column in df.columns else F.lit(None).cast("string")
    return df.agg(count_if(nonblank(cell)).cast("long").alias("n_with_value"),
                  F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# PRISMA flow
# ---------------------------------------------------------------------------

def prisma_flow(keyed: DataFrame, annotated: DataFrame | None = None,
                method_labels: Sequence[str] | None = None, not_relevant: str = "Not Relevant") -> DataFrame:
    """AGG-16: PRISMA boxes as ``(ordinal, stage, box, value)``.

    Identification counts come from the keyed records (one key-level
    aggregate); title-screen counts from the annotated table (one aggregate)
    when given; later stages are pending (null). The two one-row aggregates
    meet in one row, from which all boxes are read. Also emits ``after_dedup``
    and the survivor count ``template_rows`` next to ``for_screening`` (they
    differ when a key mixes flagged and unflagged rows)."""
    from .screen import manual_screen_condition

    screened = annotated is not None and bool(method_labels)
    row = _summary_row(keyed)
    if screened:
        other = annotated.agg(F.count(F.lit(1)).alias("_all"),
                              count_if(manual_screen_condition(method_labels, not_relevant)).alias("_in"))
        row = row.unionByName(other, allowMissingColumns=True)
        row = row.agg(*[F.max(c).alias(c) for c in row.columns])
    else:
        row = row.withColumns({"_all": F.lit(None).cast("long"), "_in": F.lit(None).cast("long")})
    boxes = [
        ("identification", "pubmed", F.col("pubmed")), ("identification", "scopus", F.col("scopus")),
        ("identification", "ieee", F.col("ieee")), ("identification", "total_raw", F.col("total_raw")),
        ("identification", "duplicates_removed", F.col("duplicates_removed")),
        ("identification", "reviews_conf_excluded", F.col("excluded_rev_conf")),
        ("identification", "after_dedup", F.col("dedup_papers")), ("identification", "for_screening", F.col("kept")),
        ("identification", "template_rows", F.col("template_rows")), ("screening", "title_screening", F.col("kept")),
        ("screening", "title_screen_excluded", F.col("_all") - F.col("_in")), ("screening", "title_screen_passed", F.col("_in")),
        ("screening", "abstract_screening", F.col("_in") if screened else F.col("kept")),
        *[(st, b, F.lit(None)) for st, b in (("eligibility", "assessed_for_eligibility"), ("eligibility", "excluded_after_abstract"),
                                             ("eligibility", "full_text_screening"), ("included", "studies_included"))],
    ]
    if screened:  # Q3: how far the annotated table is from the template it should have been made from
        boxes.append(("checks", "annotated_minus_template", F.col("_all") - F.col("template_rows")))
    return _long(row, [F.struct(F.lit(o).alias("ordinal"), F.lit(st).alias("stage"), F.lit(b).alias("box"), v.cast("long").alias("value"))
                       for o, (st, b, v) in enumerate(boxes)])
