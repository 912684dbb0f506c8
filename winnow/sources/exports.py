"""Bibliographic exports: CSV scan with pandas-like missing values (SRC-1, N4),
vendor adapters (SRC-2..5), ordered union (SET-1) and dense row ids (DED-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import IEEE_COLUMNS, NA_TOKENS, PUBMED_COLUMNS, SCOPUS_COLUMNS, SOURCES
from ..session import checkpoint

RECORD_COLUMNS = ("row_id", "title", "authors", "year", "doi", "source")


_BAD = "_bad_record"
BYTE_ORDER_MARK = "\ufeff"


def read_export(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
                na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """SRC-1: CSV with a header, every column a nullable string.

    Listed paths with one header are one scan; with different headers, each is
    read by its own and the results are united by column name (a column that a
    path lacks is null there). Files below one path (a folder, a glob) must have
    one header; another one is an error. A short row ends in nulls; a row with
    more cells than the header is an error (``read_export_parts`` sets such rows
    aside instead).

    ``multiLine`` keeps quoted newlines inside one record (each file is then
    read by one task; exports are many moderate files, so the scan still
    spreads over the cluster). Cells equal to a missing-value token become null;
    a byte-order mark is taken off.
    """
    return na_to_null(_united(spark, paths, multi_line, _checked), na_tokens)


def read_export_parts(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
                      na_tokens: Sequence[str] = NA_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``read_export`` in two tables: the rows that fit their header, and ``(file,
    cells, text)`` of the rows with surplus cells, as they stand in the file. Every
    row is in one of them."""
    bad = _united(spark, paths, multi_line, _set_aside)
    good = _united(spark, paths, multi_line, _fitting)
    return na_to_null(good, na_tokens), bad


def _united(spark: SparkSession, paths: str | Sequence[str], multi_line: bool, read) -> DataFrame:
    listed = [paths] if isinstance(paths, str) else sorted(paths)
    headers = [_reader(spark, multi_line).csv(p).columns for p in listed]
    if all(h == headers[0] for h in headers):
        return read(spark, listed, headers[0], multi_line)
    df = read(spark, listed[:1], headers[0], multi_line)
    for p, h in zip(listed[1:], headers[1:]):
        df = df.unionByName(read(spark, [p], h, multi_line), allowMissingColumns=True)
    return df


def _reader(spark: SparkSession, multi_line: bool):
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE"))


def _scan(spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool) -> tuple[DataFrame, Column]:
    """Files of one header with their raw text where a row doesn't fit it, and
    whether the row has surplus cells (a short row has not)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BAD]])
    df = (_reader(spark, multi_line).schema(schema).option("enforceSchema", False)
          .option("columnNameOfCorruptRecord", _BAD).csv(paths))
    wider = ", ".join(f"_{i} string" for i in range(len(columns) + 1))
    return df, F.from_csv(F.col(_BAD), wider, {"escape": '"', "multiLine": "true"})[f"_{len(columns)}"].isNotNull()


def _named(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").alias(c.removeprefix(BYTE_ORDER_MARK)) for c in columns]


def _checked(spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool) -> DataFrame:
    """A surplus cell raises when its row is read."""
    df, surplus = _scan(spark, paths, columns, multi_line)
    message = F.concat(F.lit(f"more than {len(columns)} cells in a row: "), F.col(_BAD))
    first, *rest = columns
    kept = F.when(surplus, F.raise_error(message).cast("string")).otherwise(F.col(f"`{first}`"))
    return df.select(kept.alias(first.removeprefix(BYTE_ORDER_MARK)), *_named(rest))


def _fitting(spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool) -> DataFrame:
    df, surplus = _scan(spark, paths, columns, multi_line)
    return df.filter(~F.coalesce(surplus, F.lit(False))).select(*_named(columns))


def _set_aside(spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool) -> DataFrame:
    df, surplus = _scan(spark, paths, columns, multi_line)
    return df.filter(surplus).select(F.col("_metadata.file_path").alias("file"), F.lit(len(columns)).alias("cells"),
                                      F.coalesce(_BAD, F.col(f"`{columns[0]}`")).alias("text"))  # a scan of the raw text alone is not allowed


def na_to_null(df: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """N4: Spark knows one ``nullValue``; map every missing-value token to null."""
    tokens = list(na_tokens)
    return df.select([
        F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
        for c in df.columns
    ])


def pick(df: DataFrame, name: str, default: Column | str | None = "") -> Column:
    """SRC-5: the column if ``name`` is one of ``df.columns`` (exact, case
    sensitive), else the fallback column or a constant. The fallback is per
    column, never per row (N3): a null cell in a present column stays null."""
    if name in df.columns:
        return F.col(f"`{name}`").cast("string")
    if isinstance(default, Column):
        return default
    return F.lit(default).cast("string")


def _file_path(df: DataFrame) -> Column:
    """The scanned file of each row for file-based frames, else ''."""
    try:
        df.select("_metadata.file_path").schema  # noqa: B018 - resolution check only
        return F.col("_metadata.file_path")
    except AnalysisException:
        return F.lit("")


def _adapt(df: DataFrame, source: str, title: Column, authors: Column, year: Column, doi: Column,
           order: Column | None) -> DataFrame:
    cols = [title.alias("title"), authors.alias("authors"), year.alias("year"), doi.alias("doi"),
            F.lit(source).alias("source"), F.lit(SOURCES.index(source)).alias("_source_ordinal")]
    cols.append(order.alias("_file_order") if order is not None else _file_path(df).alias("_file"))
    return df.select(*cols)


def adapt_pubmed(df: DataFrame, order: Column | None = None) -> DataFrame:
    """SRC-2."""
    c = PUBMED_COLUMNS
    return _adapt(df, "PubMed", pick(df, c["title"]), pick(df, c["authors"]), pick(df, c["year"]),
                  pick(df, c["doi"]), order)


def adapt_scopus(df: DataFrame, order: Column | None = None) -> DataFrame:
    """SRC-3: authors from ``Author full names``, else ``Authors``."""
    c = SCOPUS_COLUMNS
    authors = pick(df, c["authors"], default=pick(df, c["authors_fallback"]))
    return _adapt(df, "Scopus", pick(df, c["title"]), authors, pick(df, c["year"]), pick(df, c["doi"]), order)


def adapt_ieee(df: DataFrame, order: Column | None = None) -> DataFrame:
    """SRC-4: title from ``Document Title``, else ``Title``."""
    c = IEEE_COLUMNS
    title = pick(df, c["title"], default=pick(df, c["title_fallback"]))
    return _adapt(df, "IEEE", title, pick(df, c["authors"]), pick(df, c["year"]), pick(df, c["doi"]), order)


def harmonise(pubmed: DataFrame, scopus: DataFrame, ieee: DataFrame, order_col: str | None = None) -> DataFrame:
    """SET-1 + DED-4: union in PubMed, Scopus, IEEE order with a fresh dense
    ``row_id`` 0..n-1 in that order.

    Without ``order_col`` the order inside one export is its files in path
    order, each in row order (no sort: see ``assign_row_ids``). With
    ``order_col`` (an integer column, unique in each export) rows are numbered
    by it, lazily (see ``number_rows``).
    """
    order = (lambda d: F.col(f"`{order_col}`")) if order_col else (lambda d: None)
    u = (adapt_pubmed(pubmed, order(pubmed))
         .unionByName(adapt_scopus(scopus, order(scopus)))
         .unionByName(adapt_ieee(ieee, order(ieee))))
    if order_col:
        return number_rows(u, "_source_ordinal", "_file_order").select(*RECORD_COLUMNS)
    return assign_row_ids(u, segment_by=["_source_ordinal", "_file"]).select(*RECORD_COLUMNS)


CELL_BITS = 14  # rows are numbered in cells of 2**14 consecutive order values


def harmonised(records: DataFrame) -> DataFrame:
    """``harmonise`` of one table that holds the rows of all exports, told
    apart by ``source``: one scan, numbered by source and old ``row_id``."""
    ordinal = F.coalesce(*[F.when(F.col("source") == s, F.lit(i)) for i, s in enumerate(SOURCES)])
    rows = records.select("title", "authors", "year", "doi", "source", ordinal.alias("_source_ordinal"),
                          F.col("row_id").alias("_file_order"))
    return number_rows(rows, "_source_ordinal", "_file_order").select(*RECORD_COLUMNS)


def number_rows(df: DataFrame, segment: str, order: str, col: str = "row_id") -> DataFrame:
    """Dense ids 0..n-1 by (``segment``, ``order``), both integer columns, with
    no sort of the whole table and no job while the query is built.

    Rows are numbered within cells of consecutive ``order`` values; a cell's
    offset is the sum of the cells before it in its segment, plus the rows of
    the segments before. Cells are counted from the two narrow columns."""
    cell = F.shiftright(F.col(order), CELL_BITS)
    cells = df.select(segment, cell.alias("_cell")).groupBy(segment, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    sizes = df.groupBy(segment).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.map_from_entries(F.collect_list(F.struct(segment, "_n"))).alias("m")).scalar()  # one entry a segment
    earlier = F.aggregate(F.map_entries("_sizes"), F.lit(0).cast("long"),
                          lambda a, e: a + F.when(e["key"] < F.col(segment), e["value"]).otherwise(F.lit(0)))
    before = F.sum("_n").over(Window.partitionBy(segment).orderBy("_cell")) - F.col("_n")
    offsets = cells.withColumn("_sizes", sizes).select(segment, "_cell", (before + F.coalesce(earlier, F.lit(0))).alias("_before"))
    own = F.row_number().over(Window.partitionBy(segment, "_cell").orderBy(order)) - 1
    rows = df.withColumn("_cell", cell).withColumn("_own", own).join(offsets, [segment, "_cell"])
    return rows.withColumn(col, (F.col("_own") + F.col("_before")).cast("long")).drop("_cell", "_own", "_before")


_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def assign_row_ids(df: DataFrame, order_by: Sequence[str] | None = None, segment_by: Sequence[str] = (),
                   col: str = "row_id") -> DataFrame:
    """Dense ids 0..n-1 of rows that only their place in the files orders.

    * ``order_by``: ids follow that order (a distributed range sort first).
    * otherwise: ids follow ``segment_by`` (e.g. source, file) and then the
      scan order inside each file - no sort of the rows at all.

    Steps: ``monotonically_increasing_id`` (partition index in the high bits)
    -> reliable checkpoint, so both uses below see the same ids -> one stats
    row per segment (``segment_by`` values x partition) with its row count and
    first id -> offsets in two levels (inside the first segment column, then
    over its values) -> id = offset + position inside the segment. Rows of one
    file split are contiguous inside a partition, and the splits of one file
    are laid out in file order, so this is the concatenation order.
    """
    if order_by:
        df = df.orderBy(*order_by)
        segment_by = ()
    tagged = checkpoint(df.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    # without a segment column, a thousand partitions make one
    top = F.col(segment_by[0]).cast("long") if segment_by else F.floor(part / 1000)
    tagged = tagged.withColumns({"_part": part, "_top": top})
    seg = ["_top", *segment_by[1:], "_part"]
    stats = tagged.groupBy(*seg).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    sizes = stats.groupBy("_top").agg(F.sum("_n").alias("_n")).agg(
        F.map_from_entries(F.collect_list(F.struct("_top", "_n"))).alias("m")).scalar()
    earlier = F.aggregate(F.map_entries("_sizes"), F.lit(0).cast("long"),
                          lambda a, e: a + F.when(e["key"] < F.col("_top"), e["value"]).otherwise(F.lit(0)))
    w = Window.partitionBy("_top").orderBy(*segment_by[1:], "_first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_sizes", sizes).select(*seg, "_first", (F.coalesce(F.sum("_n").over(w), F.lit(0)) + F.coalesce(earlier, F.lit(0))).alias("_offset"))
    out = tagged.join(offsets, seg).withColumn(col, (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("long"))
    hidden = {col, "_file_order", "_source_ordinal", "_file"}
    keep = [c for c in df.columns if c not in hidden]
    return out.select(col, *keep, *[c for c in ("_source_ordinal", "_file_order", "_file") if c in df.columns])


def split_by_source(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records back to three vendor-shaped exports (vendor headers; ``row_id``
    kept as the export's file order)."""
    def part(src: str, cols: dict[str, str]) -> DataFrame:
        r = records.filter(F.col("source") == src)
        return r.select(F.col("row_id"), F.col("title").alias(cols["title"]),
                        F.col("authors").alias(cols["authors"]), F.col("year").alias(cols["year"]),
                        F.col("doi").alias(cols["doi"]))
    return part("PubMed", PUBMED_COLUMNS), part("Scopus", SCOPUS_COLUMNS), part("IEEE", IEEE_COLUMNS)
