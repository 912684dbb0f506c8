"""The ``records`` table: bibliographic records derived from the driver's
``documents`` and ``labels`` tables (FIXTURES.md §2), plus the annotated view
used by the report queries.

Every text-derived column (first line, md5) is computed on the documents side
*before* the join, so the join shuffles ~200 bytes per record instead of the
full document text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import APPLICATION_LABELS, CANCER_TYPE, METHOD_LABELS, NOT_RELEVANT
from ..functions.text import extract_year

# Annotated fixture columns and the label each one stands for.
FIXTURE_TAGS = {
    "m1": METHOD_LABELS[0],
    "m2": METHOD_LABELS[1],
    "m3": METHOD_LABELS[2],
    "a1": APPLICATION_LABELS[0],
    "a2": APPLICATION_LABELS[1],
    "a3": APPLICATION_LABELS[2],
    "a4": APPLICATION_LABELS[3],
    "not_relevant": NOT_RELEVANT,
    "cancer_type": CANCER_TYPE,
}

# Declared schemas of the input tables (no footer read for inference).
DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS_SCHEMA = "doc_id bigint, quality int, toxic int"
EMBEDDINGS_SCHEMA = "vec_id bigint, embedding array<float>, label int"

RECORDS_SQL = """select d.doc_id as row_id,
 case when d.doc_id % 17 = 0 then null
      when d.doc_id % 13 = 0 then 'A Systematic Review of ' || split_part(d.text, chr(10), 1)
      when d.doc_id % 19 = 0 then split_part(d.text, chr(10), 1) || ' – peer-review'
      when d.doc_id % 11 = 0 then 'Proceedings:  ' || split_part(d.text, chr(10), 1)
      else split_part(d.text, chr(10), 1) end as title,
 'Author ' || d.source as authors,
 case when d.doc_id % 10 = 0 then null else 'c' || cast(2018 + d.n_chars % 8 as string) || '.0' end as year_raw,
 case d.doc_id % 5 when 0 then null when 1 then null
      when 2 then 'https://doi.org/10.1000/' || upper(md5(d.text)) || '.'
      when 3 then 'doi: 10.1000/' || md5(d.text)
      else ' http://dx.doi.org/10.1000/' || md5(d.text) || ' ;' end as doi,
 case d.doc_id % 3 when 0 then 'PubMed' when 1 then 'Scopus' else 'IEEE' end as source,
 l.quality as m1, l.toxic as m2,
 cast(case when d.n_chars % 4 = 0 then 1 else 0 end as int) as m3,
 cast(case when d.n_chars % 2 = 0 then 1 else 0 end as int) as a1,
 cast(case when d.n_chars % 3 = 0 then 1 else 0 end as int) as a2,
 cast(case when d.lang = 'en' then 1 else 0 end as int) as a3,
 cast(case when d.lang = 'fr' then 1 else 0 end as int) as a4,
 cast(case when d.doc_id % 23 = 0 then 1 else 0 end as int) as not_relevant,
 case d.doc_id % 6 when 0 then 'Lung, Breast; Colon' when 1 then ' Lung ' when 2 then null
      when 3 then '' when 4 then 'Breast;;' else ',Glioma,Lung' end as cancer_type
from documents d left join labels l on d.doc_id = l.doc_id"""


RECORD_EXPRS = (
    "doc_id as row_id",
    """case when doc_id % 17 = 0 then cast(null as string)
             when doc_id % 13 = 0 then concat('A Systematic Review of ', substring_index(text, '\\n', 1))
             when doc_id % 19 = 0 then concat(substring_index(text, '\\n', 1), ' – peer-review')
             when doc_id % 11 = 0 then concat('Proceedings:  ', substring_index(text, '\\n', 1))
             else substring_index(text, '\\n', 1) end as title""",
    "concat('Author ', source) as authors",
    "case when doc_id % 10 = 0 then cast(null as string) else concat('c', cast(2018 + n_chars % 8 as string), '.0') end as year_raw",
    """case doc_id % 5 when 2 then concat('https://doi.org/10.1000/', upper(md5(text)), '.')
                        when 3 then concat('doi: 10.1000/', md5(text))
                        when 4 then concat(' http://dx.doi.org/10.1000/', md5(text), ' ;') end as doi""",
    "case doc_id % 3 when 0 then 'PubMed' when 1 then 'Scopus' else 'IEEE' end as source",
)
TAG_EXPRS = (
    "cast(case when n_chars % 4 = 0 then 1 else 0 end as int) as m3",
    "cast(case when n_chars % 2 = 0 then 1 else 0 end as int) as a1",
    "cast(case when n_chars % 3 = 0 then 1 else 0 end as int) as a2",
    "cast(case when lang = 'en' then 1 else 0 end as int) as a3",
    "cast(case when lang = 'fr' then 1 else 0 end as int) as a4",
    "cast(case when doc_id % 23 = 0 then 1 else 0 end as int) as not_relevant",
    """case doc_id % 6 when 0 then 'Lung, Breast; Colon' when 1 then ' Lung ' when 3 then ''
                      when 4 then 'Breast;;' when 5 then ',Glioma,Lung' end as cancer_type""",
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS_SCHEMA).parquet(f"{sf_dir}/documents.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records`` (row_id, title, authors, year_raw, doi, source, m1..m3,
    a1..a4, not_relevant, cancer_type) over the whole ``documents`` table. A
    title is the whole first line, the DOI holds the whole digest."""
    labels = spark.read.schema(LABELS_SCHEMA).parquet(f"{sf_dir}/labels.parquet")
    # text-derived columns first (one SQL expression each), then the join
    slim = _documents(spark, sf_dir).selectExpr(*RECORD_EXPRS, *TAG_EXPRS)
    tags = labels.selectExpr("doc_id as row_id", "quality as m1", "toxic as m2")
    return slim.join(tags, "row_id", "left").select("row_id", "title", "authors", "year_raw", "doi", "source", "m1", "m2",
                                                    "m3", "a1", "a2", "a3", "a4", "not_relevant", "cancer_type")


MISSING_CELL_SQL = "case row_id % 7 when 0 then 'NA' when 1 then 'n/a' when 2 then 'null' when 3 then '' when 4 then 'nan ' else authors end"


def missing_cell() -> Column:
    """A cell that holds missing-value tokens in some rows."""
    return F.expr(MISSING_CELL_SQL)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical record columns (row_id, title, authors, year, doi, source);
    ``year`` is still the raw text. From ``documents`` alone: tags are joined
    only where they are used (``records``)."""
    return _documents(spark, sf_dir).selectExpr(*RECORD_EXPRS).withColumnRenamed("year_raw", "year")


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotated table as a report reads it: record columns with the
    normalised year, and one column per label named by the label text."""
    r = records(spark, sf_dir)
    return r.select(
        "row_id", "title", "authors", extract_year("year_raw").alias("year"), "doi", "source",
        *[F.col(c).alias(name) for c, name in FIXTURE_TAGS.items()],
    )
