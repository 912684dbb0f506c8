"""Benchmark decontamination (operator 4) by template windows.

Texts become templates: a number is the placeholder NUM, a unit after a number
UNIT, a capitalised word inside a sentence NAME; every other word stands for
itself in lower case. Windows of ``WINDOW`` template tokens are hashed, and the
windows of the documents are looked up in the hash table of the benchmark's.
An item leaks into a document if the windows found near one place of it cover
at least ``COVER`` of the item's windows *and* its slots are consistent: along
the matched alignment every value of the item (a name, number or unit) goes to
one value of the document and back, in at least ``CONSISTENT`` of the slots.
Numbers may repeat or differ by chance: where ``FULL`` of the windows match,
only names and units are asked. Every place of a document is judged. So
a question with other names and numbers is caught, while texts that only share
a form, with values mixed at random, are not. ``kind`` tells ``same`` values from
``changed`` ones.

The benchmark's table is broadcast in blocks of at most ``BLOCK_WINDOWS``
windows (24 bytes each); a larger benchmark takes more passes over the
documents. Each document is judged whole within its own task, so nothing is
shuffled and no frequent window can gather rows anywhere.

Edge cases: null and empty texts match nothing; an item of fewer than
``WINDOW`` tokens is one window of its own length; windows of fewer than
``LITERALS`` plain words are left out, and an item that has no other (numbers
and names throughout) is looked up by windows of ``RAW`` of its words as they
are, all of which must be found; one of fewer than ``LITERALS`` words never matches; repeated items are reported each;
repeated documents each; an empty benchmark finds nothing; other columns are
ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import words as W
from .common import batch_slices, ship_package, table

WINDOW, LITERALS = 5, 3
COVER, CONSISTENT = 0.4, 0.8
RAW = 10  # words of a window of an item without template windows
FULL = 0.8  # share of an item's windows that needs no one-to-one numbers
BLOCK_WINDOWS = 2_000_000
SLICE = 3 << 20  # bytes of text judged at once

# Units, in lower case.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg",
         "ounce", "ounces", "pound", "pounds", "ton", "tons", "ml", "l", "litre", "litres", "liter", "liters", "gallon",
         "gallons", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days",
         "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents", "euro", "euros",
         "percent", "degree", "degrees", "mph", "kmh", "watt", "watts", "volt", "volts", "byte", "bytes", "kb", "mb", "gb")

SALT = np.uint64(0x5BF03635)
NUM, NAME, UNIT = np.uint64(1), np.uint64(2), np.uint64(3)
_GAP = W.NOT_LETTER.copy()
_GAP[48:58] = False
_STOP = np.zeros(256, np.int8)
_STOP[[10, 33, 34, 46, 58, 63]] = 1
_DIGIT = np.zeros(256, np.int8)
_DIGIT[48:58] = 1


def _unit_keys() -> np.ndarray:
    buf, _ = W.joined(list(UNITS))
    return np.sort(W.hash_spans(buf, *W.word_bounds(buf, _GAP)))


UNIT_KEYS = _unit_keys()


def templates(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template code, value, first token of each text): ``value`` is the hash
    of the word itself, ``code`` the placeholder's number or the same hash."""
    buf, ends = W.joined(texts)
    start, end = W.word_bounds(buf, _GAP)
    value = W.hash_spans(buf, start, end)
    first = np.concatenate([[0], np.searchsorted(start, ends, "left")])
    if not len(start):
        return value, value, first

    def inside(mark: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(mark[buf], out=total[1:])
        return total[b] - total[a]

    code = value.copy()
    number = inside(_DIGIT, start, end) == end - start
    before = np.r_[False, number[:-1]]
    opens = np.zeros(len(start), bool)
    opens[first[:-1][first[:-1] < len(start)]] = True
    opens[1:] |= inside(_STOP, end[:-1], start[1:]) > 0
    large = (buf >= 65) & (buf <= 90)
    large[:-1] |= (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)  # U+00C0 to U+00DE
    capitals = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(large, out=capitals[1:])
    capital = large[start] & (capitals[end] - capitals[start] == 1) & (end - start > 1)
    code[capital & ~opens] = NAME
    code[before & ~opens & np.isin(value, UNIT_KEYS)] = UNIT
    code[number] = NUM
    return code, value, first


def windows(code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, plain words) of every run of ``n`` codes."""
    m = len(code) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(m, np.uint64)
    plain = np.concatenate([[0], np.cumsum(code > 3)])
    for i in range(n):
        out += W.mix64(code[i : m + i]) * W._MIX[i]
    return W.mix64(out + np.uint64(n)), plain[n:] - plain[:m]


class Index:
    """The benchmark's windows by hash, with the items' codes and values."""

    def __init__(self, ids: list, texts: list):
        code, value, first = templates(texts)
        self.ids, self.code, self.value, self.total, self.raw = ids, [], [], [], []
        keys, owner, place, self.lengths = [], [], [], set()
        for i in range(len(ids)):
            c, v = code[first[i] : first[i + 1]], value[first[i] : first[i + 1]]
            n = min(WINDOW, len(c))
            h, plain = windows(c, n) if n else (np.empty(0, np.uint64), np.empty(0, np.int64))
            good = np.flatnonzero(plain >= LITERALS)
            raw = not len(good) and len(c) >= LITERALS
            if raw:
                n = min(RAW, len(c))
                h = windows(v, n)[0] ^ SALT
                good = np.arange(len(h))
            self.raw.append(raw)
            self.code.append(c)
            self.value.append(v)
            self.total.append(len(good))
            if len(good):
                self.lengths.add((n, raw))
                keys.append(h[good])
                owner.append(np.full(len(good), i))
                place.append(good)
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owner = np.concatenate(owner)[order] if owner else np.empty(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.empty(0, np.int64)

    def leaks(self, texts: list) -> list[tuple]:
        """(text number, item number, windows found, covered share, slots,
        consistent share, kind) of every leak into the texts."""
        code, value, first = templates(texts)
        found = []
        for n, raw in sorted(self.lengths):
            h = windows(value, n)[0] ^ SALT if raw else windows(code, n)[0]
            low = np.searchsorted(self.keys, h, "left")
            hit = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == h)
            doc = np.searchsorted(first, hit, "right") - 1
            fits = hit + n <= first[doc + 1]
            hit, doc = hit[fits], doc[fits]
            many = np.searchsorted(self.keys, h[hit], "right") - low[hit]
            at = np.repeat(low[hit], many) + _within(many)
            found.append(np.stack([np.repeat(doc, many), self.owner[at], self.place[at], np.repeat(hit, many), np.full(len(at), n)], 1))
        out = []
        if not found:
            return out
        rows = np.concatenate(found)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        cut = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]) if len(rows) else []
        for a, b in zip(cut, [*cut[1:], len(rows)]):
            got = self._judge(rows[a:b], value)
            if got:
                out.append((int(rows[a, 0]), int(rows[a, 1]), *got))
        return out

    def _judge(self, rows: np.ndarray, value: np.ndarray) -> tuple | None:
        item = int(rows[0, 1])
        span = max(len(self.code[item]), 1)
        shift = (rows[:, 3] - rows[:, 2]) // span  # rows of one copy fall into one or two neighbouring bins
        order = np.argsort(shift, kind="stable")
        rows, shift = rows[order], shift[order]
        best = None
        for b in np.unique(shift):
            near = rows[np.searchsorted(shift, b) : np.searchsorted(shift, b + 1, "right")]
            covered = len(np.unique(near[:, 2]))
            if covered / self.total[item] >= (1 if self.raw[item] else COVER) and (best is None or covered > best[0]):
                best = self._consistent(item, near, covered, value) or best
        return best

    def _consistent(self, item: int, near: np.ndarray, covered: int, value: np.ndarray) -> tuple | None:
        share = covered / self.total[item]
        pairs = {}
        for _, _, place, at, n in near:
            for k in range(n):
                if self.code[item][place + k] <= 3:
                    pairs[place + k] = (int(self.code[item][place + k]), int(self.value[item][place + k]), int(value[at + k]))
        forth, back = {}, {}
        good = asked = 0
        for kind, ours, theirs in pairs.values():
            if share >= FULL and kind == NUM:
                continue
            asked += 1
            if forth.setdefault((kind, ours), theirs) == theirs and back.setdefault((kind, theirs), ours) == ours:
                good += 1
        consistent = good / asked if asked else 1.0
        if consistent < CONSISTENT:
            return None
        same = all(ours == theirs for _, ours, theirs in pairs.values())
        return covered, share, len(pairs), consistent, "same" if same else "changed"


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of these lengths."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def _indexes(benchmark: DataFrame, id_col: str, text: str):
    """The benchmark in blocks of bounded size, one index each."""
    items = benchmark.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tokens = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(tokens / 2 / BLOCK_WINDOWS))  # a word and its gap have two bytes at least
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = items.filter(part == k).orderBy("item_id", "text").collect()
        yield Index([r["item_id"] for r in rows], [r["text"] for r in rows])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that leaks into it: doc_id, item_id,
    windows found, covered share, slots, consistent share, kind."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    kinds = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_windows long, covered double, n_slots long, consistent double, kind string"
    names = ["doc_id", "item_id", "n_windows", "covered", "n_slots", "consistent", "kind"]
    id_type = to_arrow_type(benchmark.schema[item_id].dataType)
    out = None
    for index in _indexes(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for part in batch_slices(batches, "_text", SLICE):
                got = index.leaks(part.column("_text").to_pylist())
                cols = list(zip(*got)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array([index.ids[i] for i in cols[1]], id_type),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int64()),
                     pa.array(cols[5], pa.float64()), pa.array(cols[6], pa.string())], names)

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` into which no item leaks, as they are."""
    spark = docs.sparkSession
    ship_package(spark)
    for index in _indexes(benchmark, "item_id", "text"):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for part in batch_slices(batches, text, SLICE):
                keep = np.ones(part.num_rows, bool)
                keep[[r[0] for r in shared.value.leaks(part.column(text).to_pylist())]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
