"""Golden values for the text rules (TXT-1..5), stated by hand."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from winnow.functions.text import extract_year, is_secondary_title, norm_doi, norm_text, norm_title, split_multi_value

NBSP = " "

TITLES = [
    ("state-of-the-art", "state-of-the-art", False),
    ("meta–analysis", "meta-analysis", True),
    ("Peer-Review x", "peer-review x", True),
    ("reviewer", "reviewer", False),
    ("préreview", "préreview", False),
    ("review_a", "review_a", False),
    ("Surveyed", "surveyed", True),
    ("x²½", "x²½", False),
    (f"a{NBSP}b\x1cc", "a b c", False),
    ("İstanbul", "istanbul", False),  # combining dot is not a word character
    ("ΟΔΟΣ", "οδος", False),
    ("   ", "", False),
    (None, "", False),
    ("  A  Systematic\tReview: of  X!! ", "a systematic review of x", True),
    ("State of the Art", "state of the art", True),
    ("A (review)", "a review", True),
    ("Proceedings:  Foo — Bar", "proceedings foo - bar", True),
    ("Co−operation", "co-operation", False),
    ("Deep learning; a REVIEW.", "deep learning a review", True),
]

DOIS = [
    ("doi: 10.1/AbC.,;", "10.1/abc"),
    ("https://dx.doi.org/10.1/A B;.", "10.1/ab"),
    ("HTTP://DOI.ORG/10.2/x", "10.2/x"),
    ("https://doi.org/doi:10.3/x", "doi:10.3/x"),
    (".", ""),
    (None, ""),
    (" http://dx.doi.org/10.1000/abc ;", "10.1000/abc"),
    (f"{NBSP}DOI:{NBSP} 10.5/Q ", "10.5/q"),
]

YEARS = [
    ("2023.0", "2023"),
    ("pub 12024", "1202"),
    ("x 2019-2021", "2019"),
    ("99", ""),
    ("٢٠٢٣", "٢٠٢٣"),
    (None, ""),
    ("c2020.0", "2020"),
]


def _one_col(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_titles(spark):
    df = _one_col(spark, [t for t, _, _ in TITLES])
    rows = df.select("i", norm_title("v").alias("t")).withColumn("r", is_secondary_title("t")).orderBy("i").collect()
    for (raw, want, marked), row in zip(TITLES, rows):
        assert row["t"] == want, (raw, row["t"])
        assert row["r"] is marked, (raw, row["r"])


def test_dois(spark):
    df = _one_col(spark, [d for d, _ in DOIS])
    rows = df.select("i", norm_doi("v").alias("d")).orderBy("i").collect()
    for (raw, want), row in zip(DOIS, rows):
        assert row["d"] == want, (raw, row["d"])


def test_years(spark):
    df = _one_col(spark, [y for y, _ in YEARS])
    rows = df.select("i", extract_year("v").alias("y")).orderBy("i").collect()
    for (raw, want), row in zip(YEARS, rows):
        assert row["y"] == want, (raw, row["y"])


def test_norm_text_never_null(spark):
    df = _one_col(spark, [None, "", " A B "])
    assert [r[0] for r in df.select(norm_text("v")).orderBy("i").collect()] == ["", "", "a b"]


def test_doi_not_idempotent(spark):
    df = _one_col(spark, ["https://doi.org/doi:10.3/x"])
    once = norm_doi("v")
    assert df.select(norm_doi(once)).first()[0] == "10.3/x"
    assert df.select(once).first()[0] == "doi:10.3/x"


def test_multi_value_split(spark):
    df = _one_col(spark, ["Lung, Breast; Colon", ",Glioma,Lung", "Breast;;"])
    rows = df.select(split_multi_value("v").alias("a")).collect()
    assert rows[0]["a"] == ["Lung", "Breast", "Colon"]
    assert rows[1]["a"] == ["", "Glioma", "Lung"]
    assert rows[2]["a"] == ["Breast", ""]


_text = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=40)


@settings(max_examples=25, deadline=None)
@given(st.lists(_text, min_size=1, max_size=20))
def test_title_properties(spark, values):
    df = _one_col(spark, values)
    t = norm_title("v")
    rows = df.select(t.alias("a"), norm_title(t).alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"]                      # idempotent
        assert r["a"] == r["a"].strip(" ")           # stripped
        assert "  " not in r["a"]                    # collapsed
        assert all(unicodedata.category(ch)[0] in "LN" or ch in " _-" for ch in r["a"])


@pytest.mark.parametrize("phrase", ["systematic review", "meta analysis", "workshop", "congress"])
def test_secondary_phrases_are_substrings(spark, phrase):
    df = _one_col(spark, [f"x{phrase}y"])
    assert df.select(is_secondary_title(norm_title("v"))).first()[0] is True


def _stepwise_doi(c):
    """The DOI rule spelled out one step at a time (strip, lower, two prefixes,
    whitespace, trailing punctuation) - the form the two-pass version replaces."""
    from pyspark.sql import functions as F
    from winnow.functions.text import WS, lower, strip_ws
    x = lower(strip_ws(F.coalesce(c, F.lit(""))))
    x = F.regexp_replace(x, f"^doi:{WS}*", "")
    x = F.regexp_replace(x, r"^https?://(dx\.)?doi\.org/", "")
    x = F.regexp_replace(x, f"{WS}+", "")
    return F.regexp_replace(x, r"[.,;]+\z", "")


def _stepwise_title(c):
    from pyspark.sql import functions as F
    from winnow.functions.text import WS, WS_CHARS, WORD_CHARS, lower, strip_ws
    x = F.regexp_replace(strip_ws(lower(F.coalesce(c, F.lit("")))), f"{WS}+", " ")
    x = F.translate(x, "–—−", "---")
    x = F.regexp_replace(x, f"[^{WORD_CHARS}{WS_CHARS}\\-]", "")
    return strip_ws(F.regexp_replace(x, f"{WS}+", " "))


_doiish = st.lists(st.sampled_from(["doi:", "DOI: ", "https://", "http://dx.", "doi.org/", "10.", "1/", "a", "B",
                                    " ", "\t", " ", ".", ",", ";", "–", "x²", "İ", "\x1c"]), max_size=12).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(_doiish, _text), min_size=1, max_size=30))
def test_two_pass_forms_equal_stepwise(spark, values):
    from pyspark.sql import functions as F
    df = _one_col(spark, values)
    v = F.col("v")
    rows = df.select(norm_doi(v).alias("a"), _stepwise_doi(v).alias("b"),
                     norm_title(v).alias("c"), _stepwise_title(v).alias("d")).collect()
    for r in rows:
        assert r["a"] == r["b"] and r["c"] == r["d"]


def test_locale_independent_under_turkish_jvm():
    """A JVM whose default locale is Turkish must produce the same keys."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from winnow.functions.text import norm_title, norm_doi
spark = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')
         .config('spark.driver.extraJavaOptions', '-Duser.language=tr -Duser.country=TR').getOrCreate())
df = spark.createDataFrame([('TITLE IN İSTANBUL', 'DOI: 10.1/ABCI')], 'v string, d string')
r = df.select(norm_title('v').alias('t'), norm_doi('d').alias('d')).first()
print('RESULT', r['t'], r['d'])
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    line = [l for l in out.stdout.splitlines() if l.startswith("RESULT")]
    assert line == ["RESULT title in istanbul 10.1/abci"], out.stdout + out.stderr[-2000:]
