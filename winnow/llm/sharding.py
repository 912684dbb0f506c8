"""Minimax contiguous sharding (operator 1).

Groups of equal texts are atoms on a line ordered by a 64-bit hash of the text.
The line is cut into ``shards`` contiguous runs so that the heaviest run is as
light as possible: the smallest feasible capacity is found by binary search,
each trial checked greedily, and the cuts are taken there.

The line is never collected. The driver holds *segments* (hash prefixes) with
their sums: first 2**16 of them, then, level by level, only the segments in
which a cut can still fall are split into 256. A trial that may cut inside a
segment bounds the answer from below, one that may not bounds it from above;
refining stops when both agree, which makes the capacity exact. What reaches
the driver is at most 2**16 rows and then (segments near a cut) x 256 a level,
whatever the input.

Edge cases: a null text counts as empty (size 8 and the atom of the empty
text); null ids are kept as rows; an empty table gives no rows; a group larger
than the fair share sets the capacity; with fewer atoms than shards some shards
stay empty; repeated rows are separate rows of one atom. Other columns of the
input are ignored, so their names can't clash.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

FIRST_BITS, STEP_BITS = 16, 8
CELL_ROWS = 4096  # rows that one task numbers at a time


def sized(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the 64-bit atom ``_h`` of every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(t) + 8).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(t).alias("_h"),
    )


class Segments:
    """Consecutive stretches of the line: low key, sum, and whether the stretch
    is a single atom."""

    def __init__(self, rows: list[tuple[int, int, int, bool]]):
        self.rows = sorted(rows)  # (low key, bits of its prefix, sum, single)
        self.sums = [0]
        for r in self.rows:
            self.sums.append(self.sums[-1] + r[2])

    @property
    def total(self) -> int:
        return self.sums[-1]

    def reach(self, at: int, capacity: int, inside: bool) -> int:
        """Furthest position a shard that starts at ``at`` can end; ``inside``:
        segments of several atoms may be cut anywhere."""
        to = at + capacity
        if to >= self.total:
            return self.total
        i = bisect_right(self.sums, to) - 1
        if inside and not self.rows[i][3]:
            return to
        return self.sums[i]

    def ends(self, capacity: int, shards: int, inside: bool) -> list[int]:
        """Greedy ends of the shards at this capacity."""
        out, at = [], 0
        for _ in range(shards):
            nxt = self.reach(at, capacity, inside)
            out.append(nxt)
            if nxt == at and at < self.total and not inside:
                break
            at = nxt
        return out

    def feasible(self, capacity: int, shards: int, inside: bool) -> bool:
        return self.ends(capacity, shards, inside)[-1] >= self.total

    def smallest(self, low: int, high: int, shards: int, inside: bool) -> int:
        while low < high:
            mid = (low + high) // 2
            if self.feasible(mid, shards, inside):
                high = mid
            else:
                low = mid + 1
        return low


def _segments(atoms: DataFrame, bits: int, under: list[int] | None) -> list[tuple[int, int, int, bool]]:
    if under is not None:
        atoms = atoms.filter(F.shiftright("_h", 64 - bits + STEP_BITS).isin(under))
    got = (atoms.groupBy(F.shiftright("_h", 64 - bits).alias("_p"))
           .agg(F.sum("size").alias("s"), F.min("_h").alias("a"), F.max("_h").alias("b")).collect())
    return [(r["a"] if r["a"] == r["b"] else r["_p"] << (64 - bits), bits, r["s"], r["a"] == r["b"]) for r in got]


def minimax_cuts(atoms: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity, and the first key of shards 1 to ``shards - 1``, for a
    table of (``_h`` key, ``size``); equal keys are one atom."""
    heaviest = atoms.groupBy("_h").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] or 0
    segs = Segments(_segments(atoms, FIRST_BITS, None))
    if not segs.total:
        return 0, [2**63 - 1] * (shards - 1)
    bits = FIRST_BITS
    while True:
        floor = max(heaviest, -(-segs.total // shards))
        low = segs.smallest(floor, segs.total, shards, inside=True)
        high = segs.smallest(low, segs.total, shards, inside=False)
        if low == high or bits >= 64:
            return high, _cut_keys(segs, high, shards)
        first, last = segs.ends(low, shards, False), segs.ends(high, shards, True)
        first += [first[-1]] * (shards - len(first))
        open_rows = set()
        for a, b in zip(first, last):
            i, j = bisect_left(segs.sums, a), bisect_right(segs.sums, b)
            open_rows.update(k for k in range(max(0, i - 1), min(len(segs.rows), j + 1)) if not segs.rows[k][3])
        open_rows = {k for k in open_rows if segs.rows[k][1] == bits}
        if not open_rows:
            return high, _cut_keys(segs, high, shards)
        under = [segs.rows[k][0] >> (64 - bits) for k in open_rows]
        bits += STEP_BITS
        finer = _segments(atoms, bits, under)
        segs = Segments([r for k, r in enumerate(segs.rows) if k not in open_rows] + finer)


def _cut_keys(segs: Segments, capacity: int, shards: int) -> list[int]:
    """Cuts at the found capacity: each as near the fair share of what is left
    as the later shards allow, so that the last one isn't the light one."""
    cuts, at = [], 0
    for i in range(shards - 1):
        left = shards - i - 1
        most = segs.reach(at, capacity, False)
        want = at + -(-(segs.total - at) // (left + 1))
        k = bisect_left(segs.sums, want)
        near = [segs.sums[x] for x in (k, k - 1) if 0 <= x < len(segs.sums) and at <= segs.sums[x] <= most]
        end = min(near, key=lambda x: abs(x - want), default=most)
        rest, pos = left, end
        while rest and pos < segs.total:
            nxt = segs.reach(pos, capacity, False)
            if nxt == pos:
                break
            pos, rest = nxt, rest - 1
        at = end if pos >= segs.total else most
        k = bisect_left(segs.sums, at)
        cuts.append(segs.rows[k][0] if k < len(segs.rows) else 2**63 - 1)
    return cuts


def shard(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in its shard) of every row."""
    rows = stage(sized(docs, id_col, text), "shard-rows")
    _, cuts = minimax_cuts(rows, shards)
    n = rows.count()
    parts = max(1, -(-n // (shards * CELL_ROWS)))
    which = sum((F.when(F.col("_h") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)) if cuts else F.lit(0)
    cells = rows.select("doc_id", "size", "text_crc32", which.cast("int").alias("shard"),
                        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).alias("_cell"))
    before = (cells.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_cell")) - F.col("_n"))
              .select("shard", "_cell", "_before"))
    own = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")) - 1
    return (cells.withColumn("_own", own).join(before, ["shard", "_cell"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_own") + F.col("_before")).cast("long").alias("slot")))


def op1_minimax_shards(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = shard(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
