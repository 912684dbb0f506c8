"""Values that must stay equal to the screening rules being reproduced.

Everything in the block below is a FIXED VALUE: changing any entry changes
results. They are listed plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — begin
# ---------------------------------------------------------------------------

# Bibliographic sources, in concatenation (keep-first) order.
SOURCES = ("PubMed", "Scopus", "IEEE")

# Phrases that mark a secondary or conference paper when found anywhere in the
# normalised title (plain substring test), plus one whole word.
SECONDARY_PHRASES = (
    "systematic review",
    "scoping review",
    "literature review",
    "narrative review",
    "umbrella review",
    "meta-analysis",
    "meta analysis",
    "survey",
    "state of the art",
    "proceedings",
    "symposium",
    "workshop",
    "congress",
    "conference",
)
SECONDARY_WORD = "review"

# Prefixes of the tiered duplicate key.
KEY_TITLE_YEAR = "TY:"
KEY_YEAR_SEP = "|Y:"
KEY_TITLE = "T:"
KEY_ROW = "ROW:"

# Default label lists (methods first, then applications).
METHOD_LABELS = (
    "Multimodal Foundation Models",
    "Knowledge-Grounded Models",
    "Agentic AI and Multi-Agent Systems",
)
APPLICATION_LABELS = (
    "Tumor Diagnosis and Classification",
    "Treatment Optimization",
    "Prognosis and Survival Prediction",
    "Tumor Board Simulation and Workflow Integration",
)

# Annotation columns added to the template.
NOT_RELEVANT = "Not Relevant"
CANCER_TYPE = "Cancer Type"

# Vendor export headers.
PUBMED_COLUMNS = {"title": "Title", "authors": "Authors", "year": "Publication Year", "doi": "DOI"}
SCOPUS_COLUMNS = {"title": "Title", "authors": "Author full names", "authors_fallback": "Authors",
                  "year": "Year", "doi": "DOI"}
IEEE_COLUMNS = {"title": "Document Title", "title_fallback": "Title", "authors": "Authors",
                "year": "Publication Year", "doi": "DOI"}

# Header names of the flagged table and the template, in export order.
RECORD_HEADERS = {"title": "Title", "authors": "Authors", "year": "Year", "doi": "DOI", "source": "Source"}
FLAGGED_HEADERS = {"doi_norm": "DOI_norm", "title_norm": "Title_norm", "dedup_key": "dedup_key",
                   "dup_group_size": "dup_group_size", "flag_duplicate": "flag_duplicate",
                   "flag_review_conf": "flag_review_conf"}

# Cell texts that the pandas CSV reader turns into missing values by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Screening thresholds and the validation sample.
TAG_THRESHOLD = 0.35
DIMENSION_TAG_THRESHOLD = 0.25
SCREEN_THRESHOLD = 0.75
BORDERLINE_LOW = 0.80
SAMPLE_SIZE = 30
SAMPLE_SEED = 42
SCORE_DECIMALS = 4
TREND_MIN_YEAR = 2021
DEFAULT_BATCH_SIZE = 32
MULTI_VALUE_SPLIT = "[,;]+"

# Blank columns of a sheet for a reader.
READER_COLUMNS = ("Your_Decision", "Notes")

# ---------------------------------------------------------------------------
# FIXED VALUES — end
# ---------------------------------------------------------------------------
