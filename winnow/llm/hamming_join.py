"""MinHash near-dedup (operator 11) by a multi-index Hamming join of signatures.

A document's set is its distinct two-word shingles. Its signature has ``SYMBOLS``
symbols of 16 bits, each the b-bit MinHash of one hash function, so two sets of
Jaccard similarity J differ in about (1 - J) of them. Signatures that differ in at
most ``DISTANCE`` symbols are candidates: at similarity 0.8 a pair differs in more with
odds of about 1e-5, and the odds fall fast above it. To find all of
them, signatures are cut into ``CHUNKS`` chunks. By pigeonhole two signatures within
``DISTANCE`` have a chunk with at most ``DISTANCE // CHUNKS`` = 1 error, and the errors are
enumerated: each chunk is entered once for every symbol left out. So every pair
under the distance meets under a key, with no odds in this step.

1. *Classes*: one scan gives each row its set's size and 128-bit digest and each set's
   signature; rows of equal sets are one class from here on, with its least doc_id.
2. *Postings*: keys travel packed to ranges and come back as (key, class) where two
   classes or more share the key. Of more than ``LOCAL`` classes of one batch under one key
   one travels; the others are postings at once, so a key that a family
   of copies shares does not fill one range.
3. *Contraction*: in each key, classes are confirmed against the most central one;
   those already connected need no more. Work is linear in the key's classes.
4. *Exhaustion*: where classes of different components still share a key, they form the
   group of that key's most central class. A group's sets outside its main
   component are held against all its sets in blocks of ``BLOCK`` shingles, a matrix of
   common shingles a cell; only links leave a task. So families of one template whose
   texts are all just short of a link cost cells, never lists of pairs. No cap anywhere.

Every link is confirmed on the full sets (48 bits a shingle: a mistake has odds of
about 1e-9 a pair of usual length). Only texts of classes with postings are read
again for it. Sets of fewer than four shingles have no link to a different set.

Edge cases: null, empty and blank texts have the empty set, link with nothing and
are their own component; a text of one word has one shingle; repeated rows and
equal sets share a component; a null doc_id is kept and is nobody's representative
(its component is null if it has no other); rows of one doc_id with different texts
are judged apart; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import batch_slices, maybe_broadcast, shuffle_parts, ship_package, stage, table
from .ngram_join import connect

SHINGLE, PERCENT = 2, 80
SYMBOLS, DISTANCE, CHUNKS = 96, 37, 19
assert DISTANCE // CHUNKS == 1  # one symbol left out covers the errors of the best chunk
LEAST = 4  # fewer shingles: no different set is as similar as 0.8
LOCAL = 4  # classes of a batch that travel under one key
RANGE_KEYS, LEAST_RANGES = 3_000_000, 16  # keys that one range sorts; ranges of a small table
CELL = 512  # sets confirmed against one other in one task
BLOCK = 1 << 18  # shingles of a side of a cell, about
COLUMNS = 4096  # shingles of one matrix product
ROUNDS = 2  # of contraction
SLICE = 1 << 15  # shingles hashed at once: they stay in the cache

_RNG = np.random.Generator(np.random.PCG64(11))
_XOR = _RNG.integers(0, 2**64 - 1, SYMBOLS, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------------------
# Sets and signatures
# ---------------------------------------------------------------------------

def token_sets(texts: list) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    _, _, _, keys, first = W.batch_words(texts)
    return [np.unique(W.shingles(keys[first[i] : first[i + 1]], SHINGLE)) for i in range(len(texts))]


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    two = np.array([W.mix64(tokens).sum(), W.mix64(tokens ^ _ODD).sum()]) + np.uint64(len(tokens))
    a, b = W.mix64(two).view(np.int64).tolist()
    return a, b


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The symbols of non-empty sets, one row each."""
    out = np.empty((len(sets), SYMBOLS), np.uint64)
    i = 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= SLICE):
            total += len(sets[j])
            j += 1
        tokens = np.concatenate(sets[i:j])
        first = np.cumsum([0, *[len(s) for s in sets[i : j - 1]]])
        work = np.empty_like(tokens)
        for k in range(SYMBOLS):
            np.bitwise_xor(tokens, _XOR[k], out=work)
            np.multiply(work, _MUL[k], out=work)
            out[i:j, k] = np.minimum.reduceat(work, first)
        i = j
    return (W.mix64(out) >> np.uint64(48)).astype(np.uint16)


def _members(batches):
    """Rows (doc_id, n, d1, d2, sig); ``sig`` once for every set of a batch."""
    for part in batch_slices(batches, "_text"):
        sets = token_sets(part.column("_text").to_pylist())
        marks = [digest(s) if len(s) else (None, None) for s in sets]
        new: dict = {}
        for i, m in enumerate(marks):
            if len(sets[i]) >= LEAST:
                new.setdefault(m, i)
        first = list(new.values())
        starts = np.full(len(sets) + 1, len(first) * SYMBOLS)
        starts[first] = np.arange(len(first)) * SYMBOLS
        absent = np.ones(len(sets) + 1, bool)
        absent[first] = absent[-1] = False
        symbols = signatures([sets[i] for i in first]).view(np.int16).ravel()
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
             pa.array([m[1] for m in marks], pa.int64()),
             pa.ListArray.from_arrays(pa.array(starts, pa.int32(), mask=absent), pa.array(symbols))], ["doc_id", "n", "d1", "d2", "sig"])


# ---------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------

def keys_of(symbols: np.ndarray) -> np.ndarray:
    """One key for every symbol left out of its chunk: rows x ``SYMBOLS``."""
    weighed = symbols.astype(np.uint64) * _PLACE
    out = np.empty_like(weighed)
    for chunk in np.array_split(np.arange(SYMBOLS), CHUNKS):
        whole = weighed[:, chunk].sum(1)
        for k in chunk:
            out[:, k] = W.mix64(whole - weighed[:, k] + _XOR[k])
    return out


PACKED = "range int, direct boolean, base long, keys binary, owners binary, weights binary"
LOW = np.uint64((1 << 48) - 1)


def _starts(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]])


def _packed(ranges: int):
    """Packed entries (key, class) of a batch by range. Weights are the classes that an
    entry stands for."""

    def rows_of(sid, symbols):
        keys = keys_of(symbols).ravel()
        own = np.repeat((sid & ((1 << 33) - 1)).astype(np.uint32), SYMBOLS)
        base = int(sid[0] >> 33) << 33
        order = np.lexsort((own, keys))
        keys, own = keys[order], own[order]
        start = _starts(keys)
        size = np.diff(np.r_[start, len(keys)])
        many = np.repeat(size, size)
        head = np.zeros(len(keys), bool)
        head[start] = True
        for direct, mine in ((False, head | (many <= LOCAL)), (True, many > LOCAL)):
            k, o, w = keys[mine], own[mine], np.where(many > LOCAL, many, 1)[mine].astype(np.uint32)
            where = ((k >> np.uint64(48)) % np.uint64(ranges)).astype(np.int64)
            key = (k & LOW) | ((where & 0x7FFF).astype(np.uint64) << np.uint64(48))
            if direct:  # any range will do: these are postings already
                where = np.full(len(k), int(W.mix64(np.array([base + int(sid[0])], np.uint64))[0] % np.uint64(ranges)))
            turn = np.argsort(where, kind="stable")
            key, o, w, where = key[turn], o[turn], w[turn], where[turn]
            if not len(where):
                continue
            cut = _starts(where).tolist()
            for a, b in zip(cut, [*cut[1:], len(where)]):
                some = w[a:b]
                yield int(where[a]), direct, base, key[a:b].tobytes() if direct else key[a:b].copy().view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), \
                    o[a:b].tobytes(), some.tobytes() if (some > 1).any() else b""

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 8192):
                part = batch.slice(i, 8192)
                sid = part.column("sid").to_numpy()
                symbols = part.column("sig").flatten().to_numpy().view(np.uint16).reshape(-1, SYMBOLS)
                out = [r for file in np.unique(sid >> 33) for r in rows_of(sid[sid >> 33 == file], symbols[sid >> 33 == file])]
                types = (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 ["range", "direct", "base", "keys", "owners", "weights"])

    return run


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """Postings (key, sid, weight) of a range: keys of two classes or more, and those
    that a batch found shared; the weight is the log of how many share the key."""
    r, keys, sids, weights, done = int(group["range"].iloc[0]), [], [], [], []
    for direct, base, key, own, w in zip(group["direct"], group["base"], group["keys"], group["owners"], group["weights"]):
        sid = np.frombuffer(own, np.uint32).astype(np.int64) + base
        weight = np.frombuffer(w, np.uint32) if w else np.ones(len(sid), np.uint32)
        if direct:
            done.append(pd.DataFrame({"key": np.frombuffer(key, np.int64), "sid": sid, "weight": np.log2(weight, dtype=np.float32)}))
            continue
        wide = np.zeros((len(sid), 8), np.uint8)
        wide[:, :6] = np.frombuffer(key, np.uint8).reshape(-1, 6)
        keys.append(wide.view(np.uint64).ravel())
        sids.append(sid)
        weights.append(weight)
    if keys:
        key, sid, weight = np.concatenate(keys), np.concatenate(sids), np.concatenate(weights)
        order = np.argsort(key, kind="stable")
        key, sid, weight = key[order], sid[order], weight[order]
        start = _starts(key)
        size, total = np.diff(np.r_[start, len(key)]), np.add.reduceat(weight, start)
        # a class that stands for others of its batch is a direct posting too
        mine = np.repeat(size > 1, size) & (weight == 1)
        whole = np.repeat(total, size)[mine]
        key = (key[mine] | np.uint64((r & 0x7FFF) << 48)).view(np.int64)
        done.append(pd.DataFrame({"key": key, "sid": sid[mine], "weight": np.log2(whole, dtype=np.float32)}))
    return pd.concat(done)


# ---------------------------------------------------------------------------
# Confirmation on full sets
# ---------------------------------------------------------------------------

def _packed_sets(batches):
    """(d1, d2, tokens) of every different non-empty set of a batch."""
    for part in batch_slices(batches, "_text"):
        found = {}
        for s in token_sets(part.column("_text").to_pylist()):
            if len(s) >= LEAST:
                found.setdefault(digest(s), np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in found], pa.int64()), pa.array([d[1] for d in found], pa.int64()),
                                              pa.array(list(found.values()), pa.binary())], ["d1", "d2", "tokens"])


def _tokens(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _confirm(percent: int):
    """Links (u, v) from rows in order of cell, the one set before the others."""

    def run(frames):
        hub = None
        for frame in frames:
            out = []
            for b, kind, sid, raw in zip(frame["b"], frame["kind"], frame["sid"], frame["tokens"]):
                if kind == 0:
                    hub = _tokens(raw)
                    continue
                mine = _tokens(raw)
                at = np.searchsorted(hub, mine)
                common = int((hub[np.minimum(at, len(hub) - 1)] == mine).sum())
                if 100 * common >= percent * (len(hub) + len(mine) - common):
                    out.append((sid, b))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, as (u, v). Many pairs of one ``b`` are dealt to cells."""
    pairs = stage(pairs.select("a", "b"), "hamming-pairs")
    cells = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("_k"))
    dealt = pairs.join(cells, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("_k")).alias("salt"))
    members = dealt.join(sets.withColumnRenamed("sid", "a"), "a").select("b", "salt", F.lit(1).alias("kind"), F.col("a").alias("sid"), "tokens")
    hubs = dealt.select("b", "salt").distinct().join(sets.withColumnRenamed("sid", "b"), "b").select(
        "b", "salt", F.lit(0).alias("kind"), F.col("b").alias("sid"), "tokens")
    rows = members.unionAll(hubs).repartition(shuffle_parts(pairs.sparkSession), "b", "salt")
    return stage(rows.sortWithinPartitions("b", "salt", "kind").mapInPandas(_confirm(percent), "u long, v long"), "hamming-links")


def _cell_links(one: list, two: list, percent: int) -> list[tuple[int, int]]:
    """Links between the sets (sid, comp, tokens) of two sides in different
    components, one for each set of the first side and component of the other."""
    token = np.concatenate([x[2] for x in one])
    of = np.repeat(np.arange(len(one)), [len(x[2]) for x in one])
    other = np.concatenate([x[2] for x in two])
    by = np.repeat(np.arange(len(two)), [len(x[2]) for x in two])
    known = np.unique(token)
    at = np.minimum(np.searchsorted(known, other), len(known) - 1)
    met = known[at] == other
    at, by = at[met], by[met]
    used, col = np.unique(at, return_inverse=True)  # shingles of both sides
    mine = np.searchsorted(known, token)
    place = np.minimum(np.searchsorted(used, mine), max(len(used) - 1, 0))
    both = used[place] == mine if len(used) else np.zeros(len(mine), bool)
    of, place = of[both], place[both]
    order, turn = np.argsort(place, kind="stable"), np.argsort(col, kind="stable")
    of, place, by, col = of[order], place[order], by[turn], col[turn]
    common = np.zeros((len(one), len(two)), np.float32)
    for start in range(0, len(used), COLUMNS):
        a, b = np.searchsorted(place, [start, start + COLUMNS])
        c, d = np.searchsorted(col, [start, start + COLUMNS])
        left, right = np.zeros((len(one), COLUMNS), np.float32), np.zeros((COLUMNS, len(two)), np.float32)
        left[of[a:b], place[a:b] - start] = 1
        right[col[c:d] - start, by[c:d]] = 1
        common += left @ right
    n, m = (np.array([len(x[2]) for x in side]) for side in (one, two))
    comp = [np.array([x[1] for x in side], np.int64) for side in (one, two)]
    count = np.rint(common).astype(np.int64)
    link = (100 * count >= percent * (n[:, None] + m - count)) & (comp[0][:, None] != comp[1])
    i, j = np.nonzero(link)
    _, first = np.unique(np.stack([i, comp[1][j]]), axis=1, return_index=True)
    return [(one[i[k]][0], two[j[k]][0]) for k in first]


def _confirm_cells(percent: int):
    """Links (u, v) from rows in order of cell, the first side before the second."""

    def run(frames):
        cell, sides = None, ([], [])
        for frame in frames:
            out = []
            for hub, i, j, side, sid, comp, raw in zip(*[frame[c] for c in ("hub", "i", "j", "side", "sid", "comp", "tokens")]):
                if (hub, i, j) != cell:
                    if sides[0] and sides[1]:
                        out += _cell_links(*sides, percent)
                    cell, sides = (hub, i, j), ([], [])
                sides[side].append((sid, comp, _tokens(raw)))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        if sides[0] and sides[1]:
            yield pd.DataFrame(_cell_links(*sides, percent), columns=["u", "v"], dtype="int64")

    return run


def confirmed_groups(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components of each group (hub, sid, n, comp)."""
    groups = stage(groups, "hamming-groups")
    sizes = groups.groupBy("hub", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("t"))
    cut = (sizes.groupBy("hub").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("t").alias("_all"),
                                    F.max_by("t", F.struct("c", "comp")).alias("_main")))
    cut = cut.select("hub", "main", F.ceil(F.col("_all") / BLOCK).alias("_nj"), F.ceil((F.col("_all") - F.col("_main")) / BLOCK).alias("_ni"))
    rows = groups.join(cut, "hub")

    def dealt(side: int, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        some = rows.filter("comp <> main") if side == 0 else rows
        return some.select("hub", F.pmod(F.xxhash64("sid"), F.col(own_blocks)).alias(own), "sid", "comp",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_blocks) - 1)).alias(other)).select(
            "hub", "i", "j", F.lit(side).alias("side"), "sid", "comp")

    cells = dealt(0, "i", "_ni", "j", "_nj").unionAll(dealt(1, "j", "_nj", "i", "_ni"))
    full = cells.join(sets, "sid").repartition(shuffle_parts(groups.sparkSession), "hub", "i", "j")
    return stage(full.sortWithinPartitions("hub", "i", "j", "side").mapInPandas(_confirm_cells(percent), "u long, v long"), "hamming-links")


# ---------------------------------------------------------------------------
# Components
# ---------------------------------------------------------------------------

def _near(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are within ``DISTANCE``."""
    rows = (pairs.join(sigs.select(F.col("sid").alias("a"), F.col("sig").alias("_x")), "a")
            .join(sigs.select(F.col("sid").alias("b"), F.col("sig").alias("_y")), "b"))
    differ = F.size(F.filter(F.zip_with("_x", "_y", lambda x, y: x != y), lambda d: d))
    return rows.filter(differ <= DISTANCE).select("a", "b")


def _similar_size(percent: int, a: str, b: str):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    edges = (links.join(comps.select(F.col("sid").alias("u"), F.col("comp").alias("cu")), "u")
             .join(comps.select(F.col("sid").alias("v"), F.col("comp").alias("cv")), "v")
             .filter("cu <> cv").select(F.greatest("cu", "cv").alias("u"), F.least("cu", "cv").alias("v")))
    roots = connect(edges).withColumnRenamed("node", "comp")
    return stage(comps.join(roots, "comp", "left").select("sid", "n", "central", F.coalesce("root", "comp").alias("comp")), "hamming-comps")


def class_components(posts: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(sid, comp) of the classes with postings (key, sid, weight)."""
    weights = posts.groupBy("sid").agg(F.sum("weight").alias("central"))
    comps = stage(weights.join(classes.select("sid", "n"), "sid").select("sid", "n", "central", F.col("sid").alias("comp")), "hamming-comps")
    posts, sigs = posts.select("key", "sid"), classes.select("sid", "sig")
    def mixed_keys(turn: int) -> tuple[DataFrame, DataFrame]:
        """Postings with their classes, and the most central class of each key that
        several components share (in later rounds with some chance for others)."""
        rows = posts.join(comps, "sid")
        chance = 1 + turn * F.pmod(F.xxhash64(F.lit(turn), "sid"), F.lit(1 << 20)) / (1 << 20)
        rank = F.struct((F.col("central") * chance).alias("c"), "sid")
        hubs = rows.groupBy("key").agg(F.max_by(F.struct("sid", "n", "comp"), rank).alias("hub"), F.min("comp").alias("_low"), F.max("comp").alias("_high"))
        return rows, hubs.filter("_low <> _high").select("key", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.comp").alias("hub_comp"))

    for turn in range(ROUNDS):
        rows, hubs = mixed_keys(turn)
        met = rows.join(hubs, "key").filter((F.col("comp") != F.col("hub_comp")) & _similar_size(percent, "n", "hub_n"))
        votes = met.groupBy("sid", "hub").agg(F.count(F.lit(1)).alias("c"))
        best = F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("c"), "hub"))
        pairs = votes.withColumn("_r", best).filter("_r = 1").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
        comps = _merged(comps, confirmed(_near(pairs, sigs), sets, percent))
    rows, hubs = mixed_keys(0)
    groups = rows.join(hubs.select("key", "hub"), "key").select("hub", "sid", "n", "comp").distinct()
    return _merged(comps, confirmed_groups(groups, sets, percent)).select("sid", "comp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    members = stage(rows.mapInArrow(_members, f"doc_id {kind}, n long, d1 long, d2 long, sig array<short>"), "hamming-members")
    classes = stage(members.filter("d1 is not null").groupBy("d1", "d2")
                    .agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.any_value("sig", True).alias("sig"))
                    .withColumn("sid", F.monotonically_increasing_id()), "hamming-classes")
    big = classes.filter("sig is not null")
    ranges = max(LEAST_RANGES, math.ceil(big.count() * SYMBOLS / RANGE_KEYS))
    posts = stage(big.select("sid", "sig").mapInArrow(_packed(ranges), PACKED).groupBy("range")
                  .applyInPandas(_shared, "key long, sid long, weight float"), "hamming-posts")
    some = posts.select("sid").distinct().join(classes, "sid").select("sid", "d1", "d2", "least")
    some = stage(some, "hamming-some")
    count = some.count()
    # the rows of their least ids alone are read again (rows of one id may differ: the digest decides)
    least = some.select(F.col("least").alias("_least")).distinct()
    texts = rows.join(maybe_broadcast(least, count, 32), F.col("doc_id").eqNullSafe(F.col("_least")), "left_semi")
    found = texts.select("_text").mapInArrow(_packed_sets, "d1 long, d2 long, tokens binary")
    sets = stage(found.join(maybe_broadcast(some.select("sid", "d1", "d2"), count, 48), ["d1", "d2"]).select("sid", "tokens"), "hamming-sets")
    if sets.groupBy("sid").count().filter("count > 1").limit(1).count():  # repeated rows in several batches
        sets = stage(sets.dropDuplicates(["sid"]), "hamming-sets")
    comps = class_components(posts, big, sets, percent)
    of_class = stage(classes.join(comps, "sid", "left").select("d1", "d2", "least", F.coalesce("comp", "sid").alias("comp")), "hamming-labels")
    of_comp = of_class.groupBy("comp").agg(F.min("least").alias("component"))
    label = of_class.join(of_comp, "comp").select("d1", "d2", "component")
    out = members.join(label, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op11_hamming_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
