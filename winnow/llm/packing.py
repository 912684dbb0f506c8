"""Best-fit packing (operator 5) under token, document-count and attention limits.

Each document becomes its byte-level BPE ids and a closing id 0; only longer
ones than a sequence are cut, the first piece being the short one. A piece of
length L takes the vector (L tokens, 1 document, L*L attention cost) of its
sequence's capacities.

Pieces are placed by vector best-fit in falling order of length: each goes into
the sequence where the weighted norm of what stays free is least, among those
with room in every capacity. All pieces of a length are alike, so the rule is
applied to *classes* of sequences with equal free space: the plan reads only
the histogram of lengths (at most ``capacity`` numbers) and says which ranks of
a length go to which sequences. Ranks within a length come from cells of
``CELL_ROWS`` rows, so no task or window holds a length as a whole, however
many copies there are.

Ids are made by tiktoken from the same vocabulary as byte_bpe_50k.json of the
tokenizers library (the tests hold one against the other). A batch's text is
cut before blanks that follow a non-blank, where the vocabulary's pattern
always cuts, and every different stretch is encoded once.

Edge cases: a null or empty text is the one id 0; repeated rows are separate
documents; very long texts give many pieces; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import batch_slices, fits_broadcast, ship_package, stage, table

SEQUENCE = 2048
MAX_DOCS = 2048  # documents in a sequence
WEIGHTS = (1.0, 0.01, 0.01)  # of free tokens, documents and attention cost in the norm
CELL_ROWS = 4096
VOCABULARY = "byte_bpe_50k.tiktoken"

_SPACE = W._SPACE
_ENCODERS: dict[str, "Encoder"] = {}  # of this Python worker


class Encoder:
    """Ids of many texts at once."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.code = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_of[i] = len(token)

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end)."""
        buf, ends = W.joined(texts)
        start, end, text_of, beside = _stretches(buf, ends)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        key = W.hash_spans(buf, start, end, W.EXACT)
        _, index, inverse = np.unique(key, return_index=True, return_inverse=True)
        alone = ~beside[index]
        raw, ids, place, size = buf.tobytes(), [], np.zeros(len(index), np.int64), np.zeros(len(index), np.int64)
        many = np.flatnonzero(~alone)
        if len(many):
            s, e = start[index[many]], end[index[many]]
            whole = b"".join([raw[a:b] for a, b in zip(s.tolist(), e.tolist())]).decode("utf-8", "replace")
            got = np.asarray(self.code.encode_ordinary(whole), np.uint32)
            edge = np.concatenate([[0], np.cumsum(self.bytes_of[got])])
            cut = np.searchsorted(edge, np.concatenate([[0], np.cumsum(e - s)]))
            ids.append(got)
            place[many], size[many] = cut[:-1], np.diff(cut)
        at = len(ids[0]) if ids else 0
        for k in np.flatnonzero(alone).tolist():
            got = np.asarray(self.code.encode_ordinary(raw[start[index[k]] : end[index[k]]].decode("utf-8", "replace")), np.uint32)
            ids.append(got)
            place[k], size[k] = at, len(got)
            at += len(got)
        pool, n = np.concatenate(ids), size[inverse]
        total = np.cumsum(n)
        out = pool[np.repeat(place[inverse] - (total - n), n) + np.arange(int(total[-1]))]
        last = np.concatenate([[0], total])[np.searchsorted(text_of, np.arange(len(texts)), "right")]
        return out, last


def _closes(buf: np.ndarray) -> np.ndarray:
    """At each offset, whether the character before it is certainly no white
    space: an ASCII non-blank, or a two-byte character from U+00C0 on."""
    out = np.zeros(len(buf) + 1, bool)
    out[1:] = (buf < 128) & ~_SPACE[buf]
    out[2:] |= (buf[1:] >= 128) & (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xDF)
    return out


def _stretches(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each stretch (blanks and the non-blanks after
    them), and whether it can be encoded beside others: it begins with a blank
    and its last character certainly closes it."""
    begin = np.concatenate([[0], ends[:-1]])
    blank, closes = _SPACE[buf], _closes(buf)
    flag = blank & closes[:-1]
    flag[begin] = True
    start = np.flatnonzero(flag)
    count = np.diff(np.searchsorted(start, np.append(begin, len(buf))))
    text_of = np.repeat(np.arange(len(ends)), count)
    end = np.minimum(np.append(start[1:], len(buf)), ends[text_of] - 1)
    real = end > start
    start, end = start[real], end[real]
    return start, end, text_of[real], blank[start] & closes[end]


def encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(public_tokenizers.path(name))
    return _ENCODERS[name]


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = SEQUENCE,
           vocabulary: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``, little-endian
    32-bit, if asked for) of every piece."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def run(batches):
        from winnow.llm.packing import encoder  # the worker's own, loaded once

        code = encoder(vocabulary)
        for part in batch_slices(batches, "_text", 4 << 20):
            ids, last = code.encode(part.column("_text").to_pylist())
            out, at = [[] for _ in range(6)], 0
            for row, end in enumerate(last.tolist()):
                own = np.append(ids[at:end], np.uint32(0)).astype("<u4")
                at, a, k = end, 0, 0
                b = len(own) % capacity or capacity
                while a < len(own):
                    raw = own[a:b].tobytes()
                    for col, v in zip(out, (row, k, a, b - a, zlib.crc32(raw), raw)):
                        col.append(v)
                    a, b, k = b, b + capacity, k + 1
            cols = [part.column("doc_id").take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()),
                    *[pa.array(c, pa.int64()) for c in out[2:5]]] + [pa.array(out[5], pa.binary())] * keep_ids
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


def plan(histogram: dict[int, int], capacity: int = SEQUENCE, max_docs: int = MAX_DOCS,
         max_cost: int | None = None) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces a sequence, offset):
    ranks of a length go, that many at a time, to consecutive sequences."""
    cost = max_cost or capacity * capacity
    full = np.array([capacity, max_docs, cost], float)
    weight = np.array(WEIGHTS)
    free = np.empty((0, 3), np.int64)  # a class of sequences: free capacities,
    first, count = np.empty(0, np.int64), np.empty(0, np.int64)  # its first sequence and their number
    out, opened = [], 0
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length])
        rank, left = 0, histogram[length]
        while left:
            room = (free >= need).all(1) & (count > 0)
            if not room.any():
                each = int((np.array([capacity, max_docs, cost]) // need).min())
                if not each:
                    raise ValueError(f"a piece of {length} fits no sequence")
                new = -(-left // each)
                free = np.vstack([free, [[capacity, max_docs, cost]]])
                first, count = np.append(first, opened), np.append(count, new)
                opened += new
                continue
            fit = np.flatnonzero(room)
            each = (free[fit] // need).min(1)
            rest = (free[fit] - each[:, None] * need) / full
            k = int(fit[np.argmin((rest * rest * weight).sum(1))])
            per = int((free[k] // need).min())
            bins = min(int(count[k]), left // per)
            if not bins:  # fewer pieces than one sequence of the class has room for
                per, bins = left, 1
            out.append((length, rank, rank + bins * per, int(first[k]), per, capacity - int(free[k, 0])))
            free = np.vstack([free, free[k] - per * need])
            first, count = np.append(first, first[k]), np.append(count, bins)
            first[k] += bins
            count[k] -= bins
            rank += bins * per
            left -= bins * per
        live = (count > 0) & (free[:, 0] > 0) & (free[:, 1] > 0)
        free, first, count = free[live], first[live], count[live]
    return out


def pack(rows: DataFrame, capacity: int = SEQUENCE, max_docs: int = MAX_DOCS) -> DataFrame:
    """``rows`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset."""
    spark = rows.sparkSession
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    steps = np.array(plan(counts, capacity, max_docs), np.int64).reshape(-1, 6)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    assert fits_broadcast(len(steps), 48)
    cells = spark.createDataFrame([(k, -(-n // CELL_ROWS)) for k, n in counts.items()] or [(0, 1)], "length long, _cells long")
    rows = rows.join(F.broadcast(cells), "length").withColumn(
        "_cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_cells"))).drop("_cells")
    before = rows.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = before.select("length", "_cell", (F.sum("_n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("_own", own).join(before, ["length", "_cell"]).withColumn("_rank", F.col("_own") + F.col("_before"))
    shared = spark.sparkContext.broadcast(steps)
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        steps = shared.value
        key = steps[:, 0] * (1 << 48) + steps[:, 1]
        for part in batches:
            length = part.column("length").to_numpy(zero_copy_only=False)
            rank = part.column("_rank").to_numpy(zero_copy_only=False)
            s = steps[np.searchsorted(key, length * (1 << 48) + rank, "right") - 1]
            at = rank - s[:, 1]
            cols = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(s[:, 3] + at // s[:, 4]), pa.array(s[:, 5] + at % s[:, 4] * length)],
                keep + ["sequence_id", "offset"])

    ranked = ranked.select(*keep, F.col("_rank").cast("long").alias("_rank"))
    kind = ranked.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """sequence_id and its ids in order (binary), from ``pack`` and ``pieces``
    with ids; at most ``capacity`` ids a group."""
    rows = placed.join(ids.select("doc_id", "piece", "ids_crc32", "ids").distinct(), ["doc_id", "piece", "ids_crc32"])
    return (rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")))


def packed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(stage(pieces(docs, id_col, text), "packing-pieces"))


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
