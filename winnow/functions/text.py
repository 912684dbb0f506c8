"""Text normalisation as native Column expressions (no Python UDF).

Java regular expressions are ASCII-only for ``\\s``/``\\w``/``\\d`` by default,
while the rules being reproduced use Unicode classes. The classes below spell
the Unicode sets out explicitly so every rule runs inside whole-stage codegen:

* ``WS``   - the characters ``str.isspace`` accepts.
* ``WORD`` - letters, numbers and underscore.
* digits   - ``\\p{Nd}``, any decimal digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (KEY_ROW, KEY_TITLE, KEY_TITLE_YEAR, KEY_YEAR_SEP, MULTI_VALUE_SPLIT, SECONDARY_PHRASES,
                        SECONDARY_WORD)

WS_CHARS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"[{WS_CHARS}]"
WORD_CHARS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CHARS}]"
NOT_WORD = f"[^{WORD_CHARS}]"

_STRIP = f"^{WS}+|{WS}+\\z"
_NOT_TITLE_CHAR = f"[^{WORD_CHARS}{WS_CHARS}\\-]"
_DASHES = "\u2013\u2014\u2212"  # en dash, em dash, minus sign
_YEAR = r"(\p{Nd}{4})"
_DOI_PREFIX = f"^{WS}*(doi:{WS}*)?(https?://(dx\\.)?doi\\.org/)?"
_DOI_TAIL = f"[.,;{WS_CHARS}]+\\z|{WS}+"
_SECONDARY_RE = "|".join([*(f"\\Q{p}\\E" for p in SECONDARY_PHRASES),
                       f"(^|{NOT_WORD}){SECONDARY_WORD}({NOT_WORD}|\\z)"])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c: Column | str) -> Column:
    """Locale-independent lower case. Spark's plain ``lower`` follows the JVM
    default locale for non-ASCII text (under tr_TR, ``I`` becomes a dotless
    ``ı``), so keys would depend on the cluster's locale; the ``UNICODE``
    collation lower-cases by the root Unicode rules, as Python's ``str.lower``
    does (dotted I, final sigma). Pure-ASCII text (characters == bytes) takes
    Spark's byte-wise ASCII path, which is locale-free and much cheaper."""
    x = _col(c)
    return F.when(F.length(x) == F.octet_length(x), F.lower(x)).otherwise(
        F.lower(F.collate(x, "UNICODE")).cast("string"))


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only drops spaces)."""
    return F.regexp_replace(_col(c), _STRIP, "")


def collapse_ws(c: Column | str, repl: str = " ") -> Column:
    return F.regexp_replace(_col(c), f"{WS}+", repl)


def norm_text(c: Column | str) -> Column:
    """TXT-1: null to '', lower case, strip, collapse whitespace runs to one
    space. After the collapse the only whitespace left is U+0020, so the strip
    is a plain ``trim``."""
    x = lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.trim(collapse_ws(x))


def norm_doi(c: Column | str) -> Column:
    """TXT-2: null to ''; strip; lower; drop a leading ``doi:`` and then a
    leading resolver URL; drop all whitespace; drop trailing ``.``, ``,``
    and ``;``.

    Two regex passes: (1) leading whitespace, optional ``doi:`` + whitespace,
    optional resolver URL - the same as stripping and removing the two
    prefixes in order; (2) every whitespace run, plus a trailing run of
    ``.,;`` mixed with whitespace - the same as removing whitespace first and
    then stripping the punctuation."""
    x = lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    x = F.regexp_replace(x, _DOI_PREFIX, "")
    return F.regexp_replace(x, _DOI_TAIL, "")


def norm_title(c: Column | str) -> Column:
    """TXT-3: TXT-1, dashes to ``-``, keep only word characters, whitespace and
    ``-``, then collapse and strip again.

    Whitespace is never removed by the character filter, so the first
    collapse/strip of TXT-1 is subsumed by the last one: lower, map dashes,
    filter, collapse, trim - two regex passes."""
    x = F.translate(lower(F.coalesce(_col(c).cast("string"), F.lit(""))), _DASHES, "---")
    x = F.regexp_replace(x, _NOT_TITLE_CHAR, "")
    return F.trim(collapse_ws(x))


def extract_year(c: Column | str) -> Column:
    """TXT-4: first run of four decimal digits anywhere in the text, else ''."""
    return F.regexp_extract(F.coalesce(_col(c).cast("string"), F.lit("")), _YEAR, 1)


def is_secondary_title(title_norm: Column | str) -> Column:
    """TXT-5 on an already normalised title: any phrase as a substring, or the
    whole word of the constants. Never null (the normalised title is never null).

    One ``rlike`` over quoted phrases, so the title is referenced once: if the
    optimiser inlines the title expression (e.g. into a pushed-down filter),
    it is inlined once, not once per phrase."""
    return _col(title_norm).rlike(_SECONDARY_RE)


def dedup_key(doi_norm: Column | str, title_norm: Column | str, year: Column | str,
              row_id: Column | str) -> Column:
    """DED-1 / TXT-13: DOI, else title + year, else title, else a unique row key.
    DOIs are lower case and the prefixes upper case, so tiers never collide."""
    d, t, y = _col(doi_norm), _col(title_norm), _col(year)
    return (
        F.when(d != "", d)
        .when((t != "") & (y != ""), F.concat(F.lit(KEY_TITLE_YEAR), t, F.lit(KEY_YEAR_SEP), y))
        .when(t != "", F.concat(F.lit(KEY_TITLE), t))
        # a row id is never null; coalescing makes the key provably non-null, so
        # joins on it need no inferred IS NOT NULL filter (which would make
        # otherwise identical subplans unshareable)
        .otherwise(F.concat(F.lit(KEY_ROW), F.coalesce(_col(row_id).cast("string"), F.lit(""))))
    )


def split_multi_value(c: Column | str, pattern: str = MULTI_VALUE_SPLIT) -> Column:
    """TXT-8 (array part): strip the cell, split on runs of separators, strip
    each piece. Blank pieces are kept; callers filter them after ``explode``."""
    return F.transform(F.split(strip_ws(_col(c)), pattern), lambda v: strip_ws(v))
