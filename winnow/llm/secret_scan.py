r"""Secret scans (operator 2), DataFrame functions only.

Base kinds are patterns: ``assign`` (a keyword, a sign and a value), ``access``
(an access key id) and ``hex`` (a long hexadecimal run). The method adds kind
``entropy``: over every candidate string (a long run of key characters) slides
a window whose character counts are updated by the entering and the leaving
character only; a window is hot when its Shannon entropy reaches the threshold
of the candidate's character class; the last class fits every candidate. Spans are
the stretches that hot windows cover; every step costs the same, so a candidate of any
length costs in proportion to it. A candidate that is on the allow-list as a whole (ids
in the 8-4-4-4-12 form, single repeated characters) is suppressed; of others the parts
between ``/ = _ -`` in which a pattern of the list occurs (alphabet and digit sequences,
words of examples, what the caller adds; not those that begin with ``\A``, which are
for whole candidates) are in no window. Base spans are never suppressed.

Offsets are code points, end exclusive. Positions come from splitting the text
by the pattern: pieces and matches alternate, so running lengths are offsets.

Edge cases: a null text is empty (no spans, the hash of the empty string);
repeated rows are scanned alike; an empty table gives no rows; long texts are
scanned whole; other columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

# The base kinds in the order listed (name, pattern, group that is measured, its least length).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# The same matches found faster: runs below the least length are skipped at once.
# (Not for ``assign``: there a short match still takes its characters.)
SEARCH = {"access": r"AKIA[A-Z0-9]{16,}+", "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+"}

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# (class, pattern of the whole candidate, least entropy of a window in bits); the first that fits holds
CLASSES = (
    ("hex", r"\A([0-9a-f]+|[0-9A-F]+)\z", 3.0),
    ("upper", r"\A[A-Z0-9]+\z", 3.4),
    ("lower", r"\A[a-z0-9]+\z", 3.6),
    ("mixed", r"\A(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9]).*\z", 3.7),
    ("signs", r"\A(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z]).*\z", 3.8),
    ("other", r"\A.*\z", 4.0),
)
ALLOW = (
    r"\A[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z",
    r"(?i)0123456789|123456789|abcdefghijkl|qwertyuiop",
    r"(?i)example|sample|dummy|placeholder|changeme",
    r"\A(.)\1*\z",
)

SEPARATOR = "(?<=[/=_-])|(?=[/=_-])"

ZERO, UNIT = "0", float(1 << 40)  # the character of a count of none; the unit of sums of n*log2(n)
RUNS = "array<struct<first:int,last:int>>"
SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _offsets(text: str, pattern: str, kind: str, order: int, group: int, least: int) -> Column:
    """Spans of the matches whose ``group`` has ``least`` characters."""
    whole = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.split(F.col(text), pattern, -1).alias("p"), whole.alias("m"), part.alias("g"))
    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(kind).alias("kind")))
        more = F.when(F.length(x["g"]) >= least, F.concat(F.coalesce(acc["spans"], F.array().cast(SPANS)), span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    return F.when(F.col(text).rlike(pattern),
                  F.coalesce(F.aggregate(pieces, zero, step)["spans"], F.array().cast(SPANS))).otherwise(F.array().cast(SPANS))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _runs(codes: Column, least: Column) -> Column:
    """Array of (first, last): the stretches covered by hot windows of a string given
    as places in ``ALPHABET`` (0: in no window). Counts are characters of a string, changed
    at the entering and the leaving character only; sums of n*log2(n) are whole
    numbers, so they do not depend on the way."""
    zero = F.struct(F.lit(0).alias("i"), F.lit(ZERO * len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("blank"),
                    F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.array().cast(RUNS).alias("done"))
    ways = F.array(*[F.lit(int(n * math.log2(n) * UNIT) if n else 0).cast("long") for n in range(WINDOW + 2)])
    pairs = F.arrays_zip(codes.alias("a"), F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), codes), F.lit(1), F.size(codes)).alias("b"))

    def step(acc: Column, x: Column) -> Column:
        enter, leave = x["a"], x["b"]
        n_in, n_out = (F.ascii(F.substring(acc["counts"], p, F.lit(1))) - ord(ZERO) for p in (enter, leave))
        comes, goes = (enter > 0) & (enter != leave), (leave > 0) & (enter != leave)
        less = F.when(goes, F.overlay(acc["counts"], F.char(n_out + (ord(ZERO) - 1)), leave, F.lit(1))).otherwise(acc["counts"])
        counts = F.when(comes, F.overlay(less, F.char(n_in + (ord(ZERO) + 1)), enter, F.lit(1))).otherwise(less)
        total = (acc["sum"] + F.when(comes, F.element_at(ways, n_in + 2) - F.element_at(ways, n_in + 1)).otherwise(F.lit(0))
                 + F.when(goes, F.element_at(ways, n_out) - F.element_at(ways, n_out + 1)).otherwise(F.lit(0)))
        blank = F.when(enter > 0, acc["blank"]).otherwise(acc["i"] + 1)  # the last character in no window
        return F.struct((acc["i"] + 1).alias("i"), counts.alias("counts"), total.alias("sum"), blank.alias("blank"),
                        acc["first"].alias("first"), acc["last"].alias("last"), acc["done"].alias("done"))

    def judged(acc: Column, x: Column) -> Column:
        return _let(step(acc, x), lambda now: F.when(
            (now["i"] - now["blank"] >= WINDOW) & (now["sum"] <= (math.log2(WINDOW) - least) * (WINDOW * UNIT)),
            F.struct(now["i"].alias("i"), now["counts"].alias("counts"), now["sum"].alias("sum"), now["blank"].alias("blank"),
                     F.when(now["last"] >= now["i"] - WINDOW, now["first"]).otherwise(now["i"] - WINDOW).alias("first"), now["i"].alias("last"),
                     F.when(now["last"] < now["i"] - WINDOW, F.concat(now["done"], _run(now))).otherwise(now["done"]).alias("done"))).otherwise(now))

    return F.aggregate(pairs, zero, judged, lambda acc: F.when(acc["last"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], _run(acc))))


def _run(acc: Column) -> Column:
    return F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _blanked(s: Column, allow: Sequence[str]) -> Column:
    """``s`` with blanks for the parts between separators in which a pattern of the allow-list occurs."""

    def part(x: Column) -> Column:
        hit = reduce(or_, [x.rlike(p) for p in allow], F.lit(False))
        return F.when(hit, F.repeat(F.lit(" "), F.length(x))).otherwise(x)

    return F.array_join(F.transform(F.split(s, SEPARATOR), part), "")


def _candidates(text: str) -> Column:
    """Array of (start, s): the candidate strings of a text."""
    pieces = F.arrays_zip(F.split(F.col(text), CANDIDATE, -1).alias("p"), F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0)).alias("m"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,s:string>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["p"])
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(
            (start + F.length(x["m"])).alias("at"), F.concat(acc["found"], F.array(F.struct(start.alias("start"), x["m"].alias("s")))).alias("found")))

    return F.aggregate(pieces, zero, step, lambda acc: acc["found"])


def _entropy(text: str, allow: Sequence[str]) -> Column:
    inside = [p for p in allow if not p.startswith(r"\A")]

    def measured(x: Column) -> Column:
        s = x["s"]
        least = F.coalesce(*[F.when(s.rlike(p), F.lit(t)) for _, p, t in CLASSES])
        whole = reduce(or_, [s.rlike(rf"\A(?:{p})\z") for p in allow], F.lit(False))
        some = reduce(or_, [s.rlike(p) for p in inside], F.lit(False))
        left = F.when(some, _blanked(s, inside)).otherwise(s)
        codes = F.transform(F.split(left, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        facts = F.struct(F.when(~whole, least).alias("least"), F.when(~whole, codes).alias("codes"))

        def spans(v: Column) -> Column:
            # a window of k different characters has at most log2(k) bits
            can = F.log2(F.size(F.array_distinct(v["codes"])).cast("double")) >= v["least"]
            return F.when(can, F.transform(_runs(v["codes"], v["least"]), lambda r: F.struct(
                (x["start"] + r["first"]).alias("start"), F.lit(len(BASE)).alias("ord"), (x["start"] + r["last"]).alias("end"), F.lit("entropy").alias("kind"))))

        return F.coalesce(_let(facts, spans), F.array().cast(SPANS))

    return F.when(F.col(text).rlike(CANDIDATE), F.flatten(F.transform(_candidates(text), measured))).otherwise(F.array().cast(SPANS))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _with_spans(rows: DataFrame, text: str, allow: Sequence[str]) -> DataFrame:
    """Adds ``_base`` and ``_spans``, sorted by start and kind."""
    found = [_offsets(text, SEARCH.get(k, p), k, i, g, n) for i, (k, p, g, n) in enumerate(BASE)]
    rows = rows.withColumn("_base", F.array_sort(F.concat(*found)))
    return rows.withColumn("_spans", F.array_sort(F.concat(F.col("_base"), _entropy(text, allow))))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", allow: Sequence[str] = ALLOW) -> DataFrame:
    """doc_id, ``base`` and ``spans`` (arrays of start, ord, end, kind) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return _with_spans(rows, "_text", allow).select("doc_id", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", allow: Sequence[str] = ALLOW) -> DataFrame:
    """The rows of ``docs`` with every found span of ``text`` replaced by
    ``mark`` (overlapping spans by one); a null text stays null."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = _with_spans(rows, "_text", allow)
    whole = F.col("_text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = x["start"] >= acc["at"]
        before = F.substring(whole, acc["at"] + 1, x["start"] - acc["at"])
        out = F.when(new, F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate("_spans", zero, step)
    clean = F.when(F.size("_spans") == 0, F.col(f"_row.`{text}`")).otherwise(
        F.concat(done["out"], F.substring(whole, done["at"] + 1, F.length(whole))))
    return rows.select(*[(clean if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k, *_ in BASE], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))
