"""DuckDB SQL computing the same tables as ``catalog.QUERIES``.

Written independently of the Spark code, straight from the rules: RE2 classes
spelled with ``\\x{..}``, window functions where DuckDB runs on one machine.
Views ``documents``, ``labels``, ``embeddings`` are registered by the caller.
"""

from __future__ import annotations

from ..functions.constants import APPLICATION_LABELS, METHOD_LABELS, NA_TOKENS, SECONDARY_PHRASES, SECONDARY_WORD
from ..sources.fixture import FIXTURE_TAGS, MISSING_CELL_SQL, RECORDS_SQL
from .catalog import BAND_LOW, LEX_APPLICATIONS, LEX_LABELS, LEX_METHODS, SHORT

WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_IN = WS[1:-1]
NW = r"[^\p{L}\p{N}_]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def norm_text(e: str) -> str:
    return f"regexp_replace({strip(f'lower(coalesce({e}, {q("")}))')}, '{WS}+', ' ', 'g')"


def norm_doi(e: str) -> str:
    x = f"lower({strip(f'coalesce({e}, {q("")})')})"
    x = f"regexp_replace({x}, '^doi:{WS}*', '')"
    x = rf"regexp_replace({x}, '^https?://(dx\.)?doi\.org/', '')"
    x = f"regexp_replace({x}, '{WS}+', '', 'g')"
    return f"regexp_replace({x}, '[.,;]+$', '')"


def norm_title(e: str) -> str:
    x = f"translate({norm_text(e)}, '–—−', '---')"
    x = rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_{WS_IN}\-]', '', 'g')"
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def year(e: str) -> str:
    return rf"regexp_extract(coalesce({e}, ''), '(\p{{Nd}}{{4}})', 1)"


def secondary(t: str) -> str:
    parts = [f"contains({t}, {q(p)})" for p in SECONDARY_PHRASES]
    parts.append(f"regexp_matches({t}, '(^|{NW}){SECONDARY_WORD}({NW}|$)')")
    return "(" + " or ".join(parts) + ")"


def is_one(c: str) -> str:
    return f"coalesce({c} = 1, false)"


LABELS = METHOD_LABELS + APPLICATION_LABELS
NR = ident("Not Relevant")
CT = ident("Cancer Type")

RECORDS = f"records as ({RECORDS_SQL})"
NORMED = f"""normed as (
  select row_id, title, authors, {year('year_raw')} as year, doi, source,
         {norm_doi('doi')} as doi_norm, {norm_title('title')} as title_norm
  from records)"""
KEYED = f"""keyed as (
  select *,
    case when doi_norm <> '' then doi_norm
         when title_norm <> '' and year <> '' then 'TY:' || title_norm || '|Y:' || year
         when title_norm <> '' then 'T:' || title_norm
         else 'ROW:' || cast(row_id as varchar) end as dedup_key,
    {secondary('title_norm')} as flag_review_conf
  from normed)"""
SURV = """surv as (
  select row_id, dedup_key, title, authors, year, doi, source from (
    select *, row_number() over (partition by dedup_key order by row_id) as rn
    from keyed where not flag_review_conf) where rn = 1)"""
ANNOT = "annot as (select row_id, title, authors, " + year("year_raw") + " as year, doi, source, " + ", ".join(
    f"{c} as {ident(n)}" for c, n in FIXTURE_TAGS.items()) + " from records)"
SCREEN_COND = "(" + " or ".join(is_one(ident(l)) for l in METHOD_LABELS) + f") and not {is_one(NR)}"
SCREENED = f"screened as (select * from annot where {SCREEN_COND})"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# as three exports read one after the other number them
RENUMBERED = f"""raw_records as ({RECORDS_SQL}),
records as (select cast(row_number() over (
  order by case source when 'PubMed' then 0 when 'Scopus' then 1 else 2 end, row_id) - 1 as bigint) as row_id,
  title, authors, year_raw, doi, source from raw_records)"""

BASE = with_(RECORDS, NORMED, KEYED)
REPORT = with_(RECORDS, ANNOT)
SCREEN = with_(RECORDS, ANNOT, SCREENED)


def key_summary() -> str:
    return BASE + """, k as (
  select dedup_key, count(*) as n, max(cast(flag_review_conf as int)) as any_flagged,
         min(cast(flag_review_conf as int)) as all_flagged,
         count(*) filter (where source = 'PubMed') as n_pubmed,
         count(*) filter (where source = 'Scopus') as n_scopus,
         count(*) filter (where source = 'IEEE') as n_ieee,
         count(*) filter (where doi_norm = '') as m_doi,
         count(*) filter (where title_norm = '') as m_title,
         count(*) filter (where year = '') as m_year
  from keyed group by dedup_key),
s as (
  select cast(sum(n_pubmed) as bigint) as pubmed, cast(sum(n_scopus) as bigint) as scopus,
         cast(sum(n_ieee) as bigint) as ieee, cast(sum(n) as bigint) as total_raw,
         cast(count(*) as bigint) as dedup_papers,
         cast(count(*) filter (where any_flagged = 1) as bigint) as excluded_rev_conf,
         cast(count(*) filter (where all_flagged = 0) as bigint) as template_rows,
         cast(coalesce(sum(n) filter (where n > 1), 0) as bigint) as duplicate_rows,
         cast(sum(m_doi) as bigint) as missing_doi, cast(sum(m_title) as bigint) as missing_title,
         cast(sum(m_year) as bigint) as missing_year
  from k)
"""


def _lex_words(label: str) -> list[str]:
    return sorted(set(w for w in label.lower().split() if w))


def _lex_score(label: str, text: str = "tw") -> str:
    words = _lex_words(label)
    lst = "[" + ", ".join(q(w) for w in words) + "]"
    return f"(cast(len(list_intersect({lst}, {text})) as double) / {len(words)})"


TITLE_WORDS = f"list_distinct(list_filter(string_split({norm_title('title')}, ' '), lambda w: w <> ''))"
LEXW = with_(RECORDS, NORMED, KEYED, SURV) + f", lw as (select *, {TITLE_WORDS} as tw from surv)\n"


def _tags(labels, threshold, prefix="") -> str:
    cols = []
    for l in labels:
        s = _lex_score(l)
        cols.append(f"cast(({s}) > {threshold} as int) as {ident(prefix + l)}")
        cols.append(f"(round({s}, 4) + 0.0) as {ident(prefix + l + '_score')}")
    return ", ".join(cols)


MERGED = LEXW + f""", m as (select row_id, dedup_key, title, authors, year, doi, source, {_tags(LEX_METHODS, 0.25)} from lw),
a as (select dedup_key, {_tags(LEX_APPLICATIONS, 0.25)} from lw),
merged as (select m.*, {", ".join("a." + ident(l) + ", a." + ident(l + "_score") for l in LEX_APPLICATIONS)}
           from m left join a using (dedup_key))
"""
SCORE_COLS = [ident(f"{l}_score") for l in LEX_METHODS]
PASS = "(" + " or ".join(f"coalesce({c} > 0.75, false)" for c in SCORE_COLS) + ")"
EXCLUDED = MERGED + f", ex as (select *, greatest({', '.join(SCORE_COLS)}) as max_score from merged where not {PASS})\n"


def _venn() -> str:
    labels = METHOD_LABELS
    k = len(labels)
    masks = sorted(range(1, 2 ** k), key=lambda m: (bin(m).count("1"), [-(m >> i & 1) for i in range(k)]))
    flags = [f"coalesce({ident(l)} <> 0, true)" for l in labels]
    rows = []
    for o, m in enumerate(masks):
        cond = " and ".join(f if m >> i & 1 else f"not {f}" for i, f in enumerate(flags))
        region = "".join("1" if m >> i & 1 else "0" for i in range(k))
        members = " & ".join(l for i, l in enumerate(labels) if m >> i & 1)
        rows.append(f"select {o} as ordinal, {q(region)} as region, {q(members)} as members, "
                    f"(select count(*) from screened where {cond}) as n")
    return SCREEN + ", r as (" + "\nunion all\n".join(rows) + ")\nselect ordinal, region, members, " \
        "cast(n as bigint) as n, cast(sum(n) over () as bigint) as total from r"


def _masks(condition: str, over: str) -> str:
    """Regions of all labels with the rows of ``screened`` that ``condition`` ties to them."""
    mask = " + ".join(f"case when coalesce({ident(l)} <> 0, true) then {1 << i} else 0 end" for i, l in enumerate(LABELS))
    k = len(LABELS)
    bits = " || ".join(f"cast((m >> {i}) & 1 as varchar)" for i in range(k))
    members = "array_to_string(list_filter([" + ", ".join(
        f"case when (m >> {i}) & 1 = 1 then {q(l)} end" for i, l in enumerate(LABELS)) + "], lambda x: x is not null), ' & ')"
    return SCREEN + f""", c as (select {mask} as held, count(*) as n from screened group by 1),
r as (select cast(i as int) as m from range(1, {1 << k}) t(i)),
s as (select {bits} as region, {members} as members, bit_count(m) as b, coalesce(c.n, 0) as n
      from (select m, sum(n) as n from r left join c on {condition} group by m) c)
{over}"""


VENN_ALL = _masks("held = m", """select cast(row_number() over (order by b, region desc) - 1 as int) as ordinal, region, members,
  cast(n as bigint) as n, cast(sum(n) over () as bigint) as total from s""")
VENN_OCCURRING = _masks("held = m", """select cast(b as int) as n_labels, region, members, cast(n as bigint) as n,
  cast(sum(n) over () as bigint) as total from s where n > 0""")
OVERLAPS = _masks("held & m = m", "select cast(b as int) as n_labels, region, members, cast(n as bigint) as n from s where n > 0")


def _by_source() -> str:
    parts = []
    for dim, labels in (("methods", METHOD_LABELS), ("applications", APPLICATION_LABELS)):
        for l in labels:
            for j, s in enumerate(("PubMed", "Scopus", "IEEE")):
                parts.append(
                    f"select {q(dim)} as dimension, {q(l)} as label, "
                    f"cast(coalesce(sum({ident(l)}), 0) as bigint) as total, {q(s)} as source, {j} as source_ordinal, "
                    f"cast(coalesce(sum({ident(l)}) filter (where source = {q(s)}), 0) as bigint) as n from annot")
    rows = "\nunion all\n".join(parts)
    return f"""select dimension, label, cast(row_number() over (partition by dimension, source order by total, label) - 1 as int) as label_rank,
      total, source, source_ordinal, n from ({rows})"""


def _prisma() -> str:
    ident_rows = [
        (0, "identification", "pubmed", "pubmed"), (1, "identification", "scopus", "scopus"),
        (2, "identification", "ieee", "ieee"), (3, "identification", "total_raw", "total_raw"),
        (4, "identification", "duplicates_removed", "total_raw - dedup_papers"),
        (5, "identification", "reviews_conf_excluded", "excluded_rev_conf"),
        (6, "identification", "after_dedup", "dedup_papers"),
        (7, "identification", "for_screening", "dedup_papers - excluded_rev_conf"),
        (8, "identification", "template_rows", "template_rows"),
        (9, "screening", "title_screening", "dedup_papers - excluded_rev_conf"),
    ]
    sel = [f"select {o} as ordinal, {q(st)} as stage, {q(b)} as box, cast({e} as bigint) as value from s"
           for o, st, b, e in ident_rows]
    cond = SCREEN_COND
    sel += [
        f"select 10, 'screening', 'title_screen_excluded', cast(count(*) - count(*) filter (where {cond}) as bigint) from annot",
        f"select 11, 'screening', 'title_screen_passed', cast(count(*) filter (where {cond}) as bigint) from annot",
        f"select 12, 'screening', 'abstract_screening', cast(count(*) filter (where {cond}) as bigint) from annot",
        "select 13, 'eligibility', 'assessed_for_eligibility', cast(null as bigint)",
        "select 14, 'eligibility', 'excluded_after_abstract', cast(null as bigint)",
        "select 15, 'eligibility', 'full_text_screening', cast(null as bigint)",
        "select 16, 'included', 'studies_included', cast(null as bigint)",
        "select 17, 'checks', 'annotated_minus_template', cast((select count(*) from annot) - template_rows as bigint) from s",
    ]
    return key_summary() + f", {ANNOT}\n" + "\nunion all\n".join(sel)


def _multi_value() -> str:
    return SCREEN + f""", v as (
  select unnest(string_split_regex({strip(f'cast({CT} as varchar)')}, '[,;]+')) as piece
  from screened where coalesce({strip(f'cast({CT} as varchar)')} <> '', false))
select value, cast(count(*) as bigint) as n from (select {strip('piece')} as value from v) where value <> ''
group by value"""


def _top() -> str:
    rows = []
    for l in LEX_LABELS:
        rows.append(f"select row_id, {q(l)} as label, {_lex_score(l)} as score from lw")
    return LEXW + ", sc as (" + "\nunion all\n".join(rows) + """)
select row_id, cast(rank as int) as rank, label, round(score, 4) + 0.0 as score from (
  select *, row_number() over (partition by row_id order by score desc, label) as rank from sc) where rank <= 3"""


def _cosine() -> str:
    dot = "list_dot_product"
    return f"""with lv as (select label, arg_min(embedding, vec_id)::double[] as v from embeddings group by label)
select e.vec_id, cast(lv.label as varchar) as label,
       round({dot}(e.embedding::double[], lv.v) /
             nullif(sqrt({dot}(e.embedding::double[], e.embedding::double[])) * sqrt({dot}(lv.v, lv.v)), 0), 4) + 0.0
         as score
from embeddings e, lv"""


ORACLE_SQL: dict[str, str] = {
    "harmonise_sources": with_(RECORDS) + """select cast(row_number() over (
      order by case source when 'PubMed' then 0 when 'Scopus' then 1 else 2 end, row_id) - 1 as bigint) as row_id,
    title, authors, year_raw as year, doi, source from records""",
    "missing_tokens": with_(RECORDS) + f"""select row_id, case when cell in ({', '.join(q(t) for t in NA_TOKENS)}) then null else cell end
      as authors from (select row_id, {MISSING_CELL_SQL} as cell from records)""",
    "norm_text": with_(RECORDS) + f"select row_id, {norm_text('title')} as title from records",
    "norm_title": with_(RECORDS) + f"select row_id, {norm_title('title')} as title_norm from records",
    "norm_doi": with_(RECORDS) + f"select row_id, {norm_doi('doi')} as doi_norm from records",
    "extract_year": with_(RECORDS) + f"select row_id, {year('year_raw')} as year from records",
    "secondary_flag": with_(RECORDS) + f"select row_id, {secondary(norm_title('title'))} as flag_review_conf from records",
    "dedup_key": BASE + "select row_id, dedup_key from keyed",
    "flag_duplicates": BASE + """select row_id, dedup_key, count(*) over (partition by dedup_key) as dup_group_size,
    count(*) over (partition by dedup_key) > 1 as flag_duplicate from keyed""",
    "keep_first": with_(RECORDS, NORMED, KEYED, SURV) + "select * from surv",
    "qa_missing": key_summary() + "select missing_doi, missing_title, missing_year, duplicate_rows from s",
    "source_counts": with_(RECORDS) + "select source, count(*) as n from records group by source",
    "identification_summary": key_summary() + """select * from (
      select 0 as ordinal, 'pubmed' as metric, pubmed as value from s union all
      select 1, 'scopus', scopus from s union all select 2, 'ieee', ieee from s union all
      select 3, 'total_raw', total_raw from s union all
      select 4, 'duplicates_removed', total_raw - dedup_papers from s union all
      select 5, 'dedup_papers', dedup_papers from s union all
      select 6, 'excluded_rev_conf', excluded_rev_conf from s union all
      select 7, 'kept', dedup_papers - excluded_rev_conf from s)""",
    "annotation_template": with_(RECORDS, NORMED, KEYED, SURV) + "select row_id, dedup_key, title, authors, year, doi, source, "
    + ", ".join(f"0 as {ident(l)}" for l in LABELS) + f", 0 as {NR}, '' as {CT} from surv",
    "manual_screen": SCREEN + "select row_id, title, authors, year, doi, source, "
    + ", ".join(ident(l) for l in LABELS) + " from screened",
    "manual_screen_counts": REPORT + f"""select cast(count(*) filter (where {SCREEN_COND}) as bigint) as included,
    cast(count(*) - count(*) filter (where {SCREEN_COND}) as bigint) as excluded, cast(count(*) as bigint) as total
    from annot""",
    "cooccurrence": REPORT + "\nunion all\n".join(
        f"select {q(dim)} as dimension, {q(a)} as row_label, {q(b)} as col_label, "
        f"cast(coalesce(sum(cast(coalesce({ident(a)}, 0) as int) * cast(coalesce({ident(b)}, 0) as int)), 0) as bigint) as n from annot"
        for dim, labels in (("methods", METHOD_LABELS), ("applications", APPLICATION_LABELS))
        for a in labels for b in labels),
    "method_application_matrix": REPORT + "\nunion all\n".join(
        f"select {q(m)} as method, {q(a)} as application, {q(SHORT[m])} as method_short, "
        f"{q(SHORT[a])} as application_short, "
        f"cast(count(*) filter (where {is_one(ident(m))} and {is_one(ident(a))}) as bigint) as n from annot"
        for m in METHOD_LABELS for a in APPLICATION_LABELS),
    "temporal_trends": REPORT + ", y as (select cast(try_cast(year as double) as int) as yi, * from annot)\n"
    + "\nunion all\n".join(
        f"select yi as year, {q(l)} as label, cast(coalesce(sum({ident(l)}), 0) as bigint) as n "
        f"from y where yi is not null and yi >= 2021 group by yi" for l in METHOD_LABELS),
    "category_counts": REPORT + "\nunion all\n".join(
        f"select {q(dim)} as dimension, {q(l)} as label, cast(coalesce(sum({ident(l)}), 0) as bigint) as n from annot"
        for dim, labels in (("methods", METHOD_LABELS), ("applications", APPLICATION_LABELS)) for l in labels),
    "category_counts_by_source": REPORT + _by_source(),
    "stack_offsets": REPORT + ", b as (" + _by_source() + """)
    select *, cast(coalesce(sum(n) over (partition by dimension, label order by source_ordinal
      rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from b""",
    "distribution": SCREEN + "select * from (" + "\nunion all\n".join(
        f"select {q(dim)} as dimension, {q(l)} as label, cast(coalesce(sum({ident(l)}), 0) as bigint) as n from screened"
        for dim, labels in (("methods", METHOD_LABELS), ("applications", APPLICATION_LABELS)) for l in labels)
    + ") where n > 0",
    "any_label_count": SCREEN + "\nunion all\n".join(
        f"select {q(dim)} as dimension, cast(count(*) filter (where "
        + " or ".join(f"coalesce({ident(l)} <> 0, false)" for l in labels) + ") as bigint) as n from screened"
        for dim, labels in (("methods", METHOD_LABELS), ("applications", APPLICATION_LABELS))),
    "venn_regions": _venn(),
    "venn_regions_all": VENN_ALL,
    "venn_occurring": VENN_OCCURRING,
    "inclusive_overlaps": OVERLAPS,
    "prisma_flow": _prisma(),
    "multi_value_counts": _multi_value(),
    "value_coverage": SCREEN + f"""select cast(count(*) filter (where coalesce({strip(f'cast({CT} as varchar)')} <> '', false)) as bigint)
      as n_with_value, cast(count(*) as bigint) as n_rows from screened""",
    "score_labels_lexical": LEXW + "\nunion all\n".join(
        f"select row_id, {q(l)} as label, round({_lex_score(l)}, 4) + 0.0 as score from lw" for l in LEX_LABELS),
    "threshold_tags": LEXW + f"select row_id, dedup_key, {_tags(LEX_METHODS, 0.35)} from lw",
    "top_labels": _top(),
    "merge_dimensions": MERGED + "select * from merged",
    "two_dimension_tags": MERGED + "select * from merged",
    "score_labels_model": with_(RECORDS, NORMED, KEYED, SURV) + "\nunion all\n".join(
        f"select row_id, {q(l)} as label, round(((length(coalesce(title, '')) + {i}) % 10) / 10.0, 4) + 0.0 as score from surv"
        for i, l in enumerate(LEX_METHODS)),
    "borderline_sheet": EXCLUDED + f"""select row_id, title, authors, year, doi, source, {', '.join(SCORE_COLS)}, max_score,
      '' as "Your_Decision", '' as "Notes" from ex where max_score >= {BAND_LOW}""",
    "sample_sheet": EXCLUDED + f"""select row_id, title, authors, year, doi, source, {', '.join(SCORE_COLS)}, max_score,
      '' as "Your_Decision", '' as "Notes"
    from ex where max_score < {BAND_LOW} order by md5('42:' || cast(row_id as varchar)), row_id limit 30""",
    "score_screen": MERGED + f"select row_id, dedup_key, {PASS} as title_screen_pass from merged",
    "max_score_bands": EXCLUDED + f"""select row_id, max_score,
      case when max_score >= {BAND_LOW} then 'borderline' when max_score < {BAND_LOW} then 'deep' end as band from ex""",
    "excluded_sample": EXCLUDED + f"""select row_id, title, authors, year, doi, source, {', '.join(SCORE_COLS)}, max_score,
      '' as "Your_Decision", '' as "Notes"
    from ex where max_score < {BAND_LOW} order by md5('42:' || cast(row_id as varchar)), row_id limit 30""",
    "score_labels_cosine": _cosine(),
}
ORACLE_SQL["cooccurrence_bitmaps"] = ORACLE_SQL["cooccurrence"]
ORACLE_SQL["stored_identification"] = with_(RENUMBERED, NORMED, KEYED) + """select row_id, source, doi_norm, title_norm, year, dedup_key,
  count(*) over (partition by dedup_key) as dup_group_size, count(*) over (partition by dedup_key) > 1 as flag_duplicate, flag_review_conf from keyed"""
ORACLE_SQL["identification_in_batches"] = ORACLE_SQL["stored_identification"]
_READ = ", ".join(f"case when {c} in ({', '.join(q(t) for t in NA_TOKENS)}) then null else {c} end as {c}" for c in ("title", "authors", "year", "doi", "source"))
ORACLE_SQL["stored_annotations"] = SCREEN + f"select row_id, {_READ}, {', '.join(ident(l) for l in LABELS)} from screened"
ORACLE_SQL["stored_scores"] = ORACLE_SQL["score_labels_lexical"]
ORACLE_SQL["top_labels_indexed"] = ORACLE_SQL["top_labels"]
