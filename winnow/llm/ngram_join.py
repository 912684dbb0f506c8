"""N-gram Jaccard join (operator 7): all links of similarity 0.8 and their groups.

A document's set is its distinct five-word shingles. One global order of all
shingles, rarest first, does the work twice. Two sets of Jaccard similarity
0.8 share a token among the first n - ceil(0.8 n) + 1 of each (prefix filter);
in this order these are mostly tokens that no other set has, so hardly any
unrelated sets meet. And read from its frequent end, the order lets similar
sets share long paths of a prefix tree (``prefix_tree``), in which candidates
are verified with shared partial overlaps and pruned by remaining length.

1. *Members*: one scan gives every row its set's size and 64-bit id; rows with
   equal sets are one set from here on.
2. *Shared tokens*: a second scan sends each batch's tokens, packed as binary
   blocks, to token ranges; there the sets of every token are counted. Only
   tokens of two sets or more come back, packed again, to buckets of sets. Very frequent tokens (estimated in the
   first scan) don't travel: their place in the order is last, and every set
   knows that they are shared. A set whose shared tokens are fewer than 0.8 n
   has no link and leaves.
3. *Contraction*: in every prefix-token group, members are verified against the
   hub, the most central set first, in a fixed number of rounds; sets
   already connected need no more tests. Work is linear in the group's size.
4. *Exhaustion*: where sets of different components still share a prefix token, they
   form the group of that token's most central set. The group's sets are kept in prefix
   trees of up to ``CELL``, and every set outside the group's main component is
   searched for in each tree, all of a cell's probes in the one tree. Only links
   leave a task: pairs that are just short of a link are never listed.

Nothing is capped: hub rounds only spare work. A hub's members are dealt to
cells of ``CELL`` sets, each with its own tree. Memory is bounded by a batch, a
token range, a bucket or a cell. Sets are compared by 64-bit hashes cut to 48 bits within
a range, so two different shingles of one pair are mistaken with odds of about
1e-9 a pair.

Edge cases: null, empty and blank texts have the empty set, are linked with
nothing and are their own component; texts of one to four words have one
shingle; repeated rows and rows with equal sets share a component; a null
doc_id is kept and is nobody's representative; an empty table gives no rows;
other columns are ignored. ``keep_one`` states what happens to an id with several texts.
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
from .prefix_tree import PrefixTree

SHINGLE, PERCENT = 5, 80
HEAVY = 0.002  # a token in more than this share of rows is very frequent
RANGE_TOKENS, LEAST_RANGES = 3_000_000, 16  # tokens that one range counts at a time; ranges of a small table
SLICE = 2 << 20  # bytes of text whose sets are made at once; twice that when their tokens are packed
PARTS = 16  # parts of a range's tokens that are sorted one after another
CELL = 512  # sets in one tree
HUBS, ROUNDS = 1, 2  # hubs that a set is tested against in a round; rounds before exhaustion
LOW = np.uint64((1 << 48) - 1)
MAX_DF = (1 << 14) - 1


def token_sets(texts: list, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    _, _, _, keys, first = W.batch_words(texts)
    return [np.unique(W.shingles(keys[first[i] : first[i + 1]], n)) for i in range(len(texts))]


def set_id(tokens: np.ndarray) -> int:
    return int(W.mix64(np.array([W.mix64(tokens).sum() + np.uint64(len(tokens))]))[0].view(np.int64))


def _members(n: int):
    """Rows (doc_id, n, sid) and, for frequent tokens of a batch, (token, count)."""

    def run(batches):
        for part in batch_slices(batches, "_text", SLICE):
            sets = token_sets(part.column("_text").to_pylist(), n)
            size = pa.array([len(s) for s in sets], pa.int64())
            sid = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
            none = pa.nulls(len(sets), pa.int64())
            names = ["doc_id", "n", "sid", "token", "count"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, sid, none, none], names)
            token, count = np.unique(np.concatenate(sets), return_counts=True)
            often = count >= max(4, HEAVY / 2 * len(sets))
            m = int(often.sum())
            if m:
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, part.schema.field("doc_id").type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                     pa.array(token[often].view(np.int64)), pa.array(count[often].astype(np.int64))], names)

    return run


BLOCK = "range int, kind int, sids binary, counts binary, tokens binary"
PLAIN, FREQUENT, SIZE = 0, 1, 2  # kinds of blocks: tokens, very frequent tokens, sizes of sets


def _cuts(values: np.ndarray):
    """Bounds of the runs of equal values."""
    if len(values):
        a = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]).tolist()
        yield from zip(a, [*a[1:], len(values)])


def _blocks(n: int, ranges: int, heavy: np.ndarray):
    """Packed tokens of a batch's different sets: tokens by range; frequent
    tokens and set sizes by the set's own bucket."""
    names = ["range", "kind", "sids", "counts", "tokens"]

    def run(batches):
        for part in batch_slices(batches, "_text", 2 * SLICE):
            sets = {set_id(s): s for s in token_sets(part.column("_text").to_pylist(), n) if len(s)}
            if not sets:
                continue
            rows = []
            sids, size = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()], np.int32)
            bucket = sids % ranges
            order = np.argsort(bucket, kind="stable")
            for a, b in _cuts(bucket[order]):
                rows.append((int(bucket[order[a]]), SIZE, sids[order[a:b]].tobytes(), size[order[a:b]].tobytes(), b""))
            token, owner = np.concatenate(list(sets.values())), np.repeat(np.arange(len(sids), dtype=np.int32), size)
            often = np.zeros(len(token), bool)
            if len(heavy):
                often = heavy[np.minimum(np.searchsorted(heavy, token), len(heavy) - 1)] == token
            for kind, mine in ((PLAIN, ~often), (FREQUENT, often)):
                t, own = token[mine], owner[mine]
                where = ((t >> np.uint64(48)) % np.uint64(ranges)).astype(np.int32) if kind == PLAIN else bucket[own]
                order = np.argsort(where, kind="stable")
                t, own, where = t[order], own[order], where[order]
                for a, b in _cuts(where):
                    who, count = np.unique(own[a:b], return_counts=True)
                    raw = t[a:b].copy().view(np.uint8).reshape(-1, 8)[:, : 6 if kind == PLAIN else 8]
                    rows.append((int(where[a]), kind, sids[who].tobytes(), count.astype(np.int32).tobytes(), np.ascontiguousarray(raw).tobytes()))
            types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)

    return run


def _key(df: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Token as a number whose order is the global one, rarest first."""
    return (np.minimum(df, MAX_DF).astype(np.int64) << 49) | (token & np.uint64((1 << 49) - 1)).astype(np.int64)


SHARED = ["bucket", "kind", "sids", "counts", "keys"]


def _shared(ranges: int, heavy: np.ndarray, heavy_df: np.ndarray):
    """For the sets of a range, packed by bucket: their tokens that other sets
    have too, as keys."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        r, out = int(group["range"].iloc[0]), []
        for kind, sids, counts, tokens in zip(group["kind"], group["sids"], group["counts"], group["tokens"]):
            if kind == SIZE:
                out.append((r, SIZE, sids, counts, b""))
            elif kind == FREQUENT:
                t = np.frombuffer(tokens, np.uint64)
                out.append((r, PLAIN, sids, counts, _key(heavy_df[np.searchsorted(heavy, t)], t).tobytes()))
        rest = group[group["kind"] == PLAIN]
        if len(rest):
            sid = np.concatenate([np.frombuffer(x, np.int64) for x in rest["sids"]])
            count = np.concatenate([np.frombuffer(x, np.int32) for x in rest["counts"]])
            raw = np.frombuffer(b"".join(rest["tokens"]), np.uint8).reshape(-1, 6)
            ids, number = np.unique(sid, return_inverse=True)  # a set seen in several batches counts once
            everyone = np.repeat(number.astype(np.int32), count)
            salt = W.mix64(np.array([r % (1 << 15)], np.uint64))[0] & ~LOW
            keys, owners = [], []
            for part in range(PARTS):  # the low bits of a token: what is sorted at once is a part of the range
                mine = np.flatnonzero(raw[:, 0] % PARTS == part)
                wide = np.zeros((len(mine), 8), np.uint8)
                wide[:, :6] = raw[mine]
                token, own = wide.view(np.uint64).ravel(), everyone[mine]
                order = np.lexsort((own, token))
                token, own = token[order], own[order]
                new = np.r_[True, (token[1:] != token[:-1]) | (own[1:] != own[:-1])][: len(token)]
                token, own = token[new], own[new]
                start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]][: len(token)])
                df = np.diff(np.r_[start, len(token)])
                df = np.repeat(df, df)
                keys.append(_key(df[df > 1], token[df > 1] ^ salt))
                owners.append(own[df > 1])
            key, own = np.concatenate(keys), np.concatenate(owners)
            bucket = ids[own] % ranges
            order = np.lexsort((own, bucket))
            key, own, bucket = key[order], own[order], bucket[order]
            for a, b in _cuts(bucket):
                who, many = np.unique(own[a:b], return_counts=True)
                out.append((int(bucket[a]), PLAIN, ids[who].tobytes(), many.astype(np.int32).tobytes(), key[a:b].tobytes()))
        return pd.DataFrame(out, columns=SHARED)

    return run


def _survivors(percent: int):
    """Sets of a bucket with enough shared tokens: keys in order, how many of
    them belong to the prefix, and how central the set is (mean log frequency of
    its tokens): in a family of copies, the text that most others resemble."""
    columns = ["sid", "n", "prefix", "central", "keys"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sizes, rest = group[group["kind"] == SIZE], group[group["kind"] == PLAIN]
        if not len(rest):
            return pd.DataFrame([], columns=columns)
        known, first = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in sizes["sids"]]), return_index=True)
        size = np.concatenate([np.frombuffer(x, np.int32) for x in sizes["counts"]])[first]
        sid = np.concatenate([np.frombuffer(x, np.int64) for x in rest["sids"]])
        count = np.concatenate([np.frombuffer(x, np.int32) for x in rest["counts"]])
        key, own = np.concatenate([np.frombuffer(x, np.int64) for x in rest["keys"]]), np.repeat(sid, count)
        order = np.argsort(own, kind="stable")
        key, own, out = key[order], own[order], []
        for a, b in _cuts(own):
            n = int(size[np.searchsorted(known, own[a])])
            least = -(-percent * n // 100)
            if b - a < least:
                continue
            keys = np.unique(key[a:b])
            if len(keys) >= least:
                central = float(np.log2((keys >> 49).astype(float)).sum() / n)
                out.append((int(own[a]), n, max(0, (n - least + 1) - (n - len(keys))), central, keys.tobytes()))
        return pd.DataFrame(out, columns=columns)

    return run


def _postings(frames):
    for frame in frames:
        frame = frame[frame["prefix"] > 0]
        for at in range(0, len(frame), 1024):
            some = frame.iloc[at : at + 1024]
            prefix = some["prefix"].to_numpy()
            first = np.repeat(np.cumsum(prefix) - prefix, prefix)
            unique = some["n"].to_numpy() - some["keys"].map(len).to_numpy() // 8
            yield pd.DataFrame({
                "token": np.concatenate([np.frombuffer(raw, np.int64, p) for raw, p in zip(some["keys"], prefix)]),
                "sid": np.repeat(some["sid"].to_numpy(), prefix), "n": np.repeat(some["n"].to_numpy(), prefix),
                "central": np.repeat(some["central"].to_numpy(), prefix),
                "pos": np.repeat(unique, prefix) + np.arange(len(first)) - first})


def _verify_cells(percent: int):
    """Links (a, b) of the cells of a partition: rows in order of cell, the hub
    (kind 0) before its members."""

    def links(hub, members):
        if hub is None or not members:
            return []
        sets = [np.frombuffer(m[2], np.int64) for m in members]
        probe = np.frombuffer(hub[2], np.int64)
        known = np.unique(np.concatenate([probe, *sets]))
        ranks = [len(known) - 1 - np.searchsorted(known, s)[::-1] for s in (probe, *sets)]  # frequent first
        tree = PrefixTree(ranks[1:], np.array([m[1] for m in members]))
        return [(members[i][0], hub[0]) for i, _ in tree.search(ranks[0], hub[1], percent, len(known))]

    def run(frames):
        cell, hub, members = None, None, []
        for frame in frames:
            out = []
            for b, salt, kind, sid, n, keys in frame[["b", "salt", "kind", "sid", "n", "keys"]].itertuples(index=False):
                if (b, salt) != cell or len(members) >= CELL:
                    out += links(hub, members)
                    members = []
                    if (b, salt) != cell:
                        cell, hub = (b, salt), None
                if kind == 0:
                    hub = (sid, n, keys)
                else:
                    members.append((sid, n, keys))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        yield pd.DataFrame(links(hub, members), columns=["u", "v"], dtype="int64")

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, as (u, v)."""
    pairs = stage(pairs.select("a", "b"), "ngram-pairs")
    cells = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("_k"))
    dealt = pairs.join(cells, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("_k")).alias("salt"))
    dealt = maybe_broadcast(dealt, pairs.count(), 40)  # else the sets, far wider, would move to meet them
    members = dealt.join(sets.withColumnRenamed("sid", "a"), "a").select(
        "b", "salt", F.lit(1).alias("kind"), F.col("a").alias("sid"), "n", "keys")
    heads = dealt.select("b", "salt").distinct()
    hubs = maybe_broadcast(heads, pairs.count(), 32).join(sets.withColumnRenamed("sid", "b"), "b").select(
        "b", "salt", F.lit(0).alias("kind"), F.col("b").alias("sid"), "n", "keys")
    rows = members.unionByName(hubs).repartition(shuffle_parts(pairs.sparkSession), "b", "salt")
    return rows.sortWithinPartitions("b", "salt", "kind").mapInPandas(_verify_cells(percent), "u long, v long")


def _verify_groups(percent: int):
    """Links (u, v) of the cells of a partition: rows in order of cell, the probes
    (side 0) before the sets of the tree. One link for each probe and component."""

    def links(probes, members):
        if not probes or not members:
            return []
        sets = [np.frombuffer(m[3], np.int64) for m in members]
        tests = [np.frombuffer(p[3], np.int64) for p in probes]
        known = np.unique(np.concatenate([*sets, *tests]))
        ranks = [len(known) - 1 - np.searchsorted(known, s)[::-1] for s in sets]  # frequent first
        tree, out = PrefixTree(ranks, np.array([m[1] for m in members])), {}
        for (sid, n, comp, _), keys in zip(probes, tests):
            for i, _ in tree.search(len(known) - 1 - np.searchsorted(known, keys)[::-1], n, percent, len(known)):
                if members[i][2] != comp:
                    out.setdefault((sid, members[i][2]), members[i][0])
        return [(sid, other) for (sid, _), other in out.items()]

    def run(frames):
        cell, sides = None, ([], [])
        for frame in frames:
            out = []
            for hub, i, j, side, sid, n, comp, keys in frame[["hub", "i", "j", "side", "sid", "n", "comp", "keys"]].itertuples(index=False):
                if (hub, i, j) != cell:
                    out += links(*sides)
                    cell, sides = (hub, i, j), ([], [])
                sides[side].append((sid, n, comp, keys))
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        yield pd.DataFrame(links(*sides), columns=["u", "v"], dtype="int64")

    return run


def verified_groups(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components of every group (hub, sid, comp)."""
    groups = stage(groups, "ngram-groups")
    sizes = groups.groupBy("hub", "comp").agg(F.count(F.lit(1)).alias("c"))
    cut = sizes.groupBy("hub").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("_all"), F.max("c").alias("_main"))
    cut = cut.select("hub", "main", F.ceil(F.col("_all") / CELL).alias("_nj"), F.ceil((F.col("_all") - F.col("_main")) / CELL).alias("_ni"))
    rows = groups.join(cut, "hub")

    def dealt(some: DataFrame, side: int, own: str, other: str) -> DataFrame:
        return some.select("hub", F.pmod(F.xxhash64("sid"), F.col(f"_n{own}")).alias(own), "sid", "comp",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_n{other}") - 1)).alias(other)).select(
            "hub", "i", "j", F.lit(side).alias("side"), "sid", "comp")

    cells = dealt(rows.filter("comp <> main"), 0, "i", "j").unionAll(dealt(rows, 1, "j", "i"))
    cells = stage(cells, "ngram-cells")
    full = maybe_broadcast(cells, cells.count(), 56).join(sets.select("sid", "n", "keys"), "sid")
    full = full.repartition(shuffle_parts(groups.sparkSession), "hub", "i", "j")
    return full.sortWithinPartitions("hub", "i", "j", "side").mapInPandas(_verify_groups(percent), "u long, v long")


def connect(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component of the edges (u, v), by
    alternating large-star and small-star steps over written tables."""
    now, mark = stage(edges.select("u", "v").distinct(), "ngram-edges"), None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.filter("u <> v"), "ngram-large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "ngram-edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)


def _merge(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (sid, comp) with those of linked sets made one."""
    c = comps.select(F.col("sid"), F.col("comp"))
    edges = (links.join(c.select(F.col("sid").alias("u"), F.col("comp").alias("cu")), "u")
             .join(c.select(F.col("sid").alias("v"), F.col("comp").alias("cv")), "v")
             .filter("cu <> cv").select(F.greatest("cu", "cv").alias("u"), F.least("cu", "cv").alias("v")))
    roots = connect(edges).withColumnRenamed("node", "comp")
    return stage(c.join(roots, "comp", "left").select("sid", F.coalesce("root", "comp").alias("comp")), "ngram-comps")


def _similar_size(percent: int, a: str, b: str):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def set_components(sets: DataFrame, percent: int) -> DataFrame:
    """(sid, comp) of the surviving sets."""
    posts = stage(sets.select("sid", "n", "prefix", "central", "keys")
                  .mapInPandas(_postings, "token long, sid long, n long, central double, pos long"),
                  "ngram-postings")
    comps = stage(posts.select("sid").distinct().withColumn("comp", F.col("sid")), "ngram-comps")
    def mixed_tokens(turn: int) -> tuple[DataFrame, DataFrame]:
        """Postings with their components, and the hub of each token that several
        components share: the most central set, in later rounds with some chance for others."""
        rows = posts.join(comps, "sid")
        chance = F.pmod(F.xxhash64(F.lit(turn), "sid"), F.lit(1 << 20)) / (1 << 20)
        h = F.struct((chance * turn - F.col("central")).alias("rank"), "sid")
        hubs = (rows.groupBy("token")
                .agg(F.min_by("sid", h).alias("hub"), F.min_by("n", h).alias("hub_n"), F.min_by("comp", h).alias("hub_comp"),
                     F.min("comp").alias("_low"), F.max("comp").alias("_high"))
                .filter("_low <> _high").drop("_low", "_high"))
        return rows, hubs

    for turn in range(ROUNDS):
        rows, hubs = mixed_tokens(turn)
        near = rows.join(hubs, "token").filter((F.col("comp") != F.col("hub_comp")) & _similar_size(percent, "n", "hub_n"))
        votes = near.groupBy("sid", "hub").agg(F.count(F.lit(1)).alias("c"))
        best = F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("c"), "hub"))
        pairs = votes.withColumn("_r", best).filter(F.col("_r") <= HUBS).select(F.col("sid").alias("a"), F.col("hub").alias("b"))
        comps = _merge(comps, stage(verified(pairs, sets, percent), "ngram-links"))
    rows, hubs = mixed_tokens(0)
    groups = rows.join(hubs.select("token", "hub"), "token").select("hub", "sid", "comp").distinct()
    return _merge(comps, stage(verified_groups(groups, sets, percent), "ngram-links"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE,
                   percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    return _grouped(docs, id_col, text, n, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least.id", "doc_id").alias("component_id"))


def _grouped(docs: DataFrame, id_col: str, text: str, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, sid and ``least``, the (id, sid) of its component's first row, of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = stage(rows.mapInArrow(_members(n), f"doc_id {kind}, n long, sid long, token long, count long"), "ngram-members")
    members = found.filter("n is not null").select("doc_id", "n", "sid")
    total = members.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens")).first()
    often = (found.filter("token is not null").groupBy("token").agg(F.sum("count").alias("c"))
             .filter(F.col("c") >= HEAVY / 2 * (total["rows"] or 0)).collect())  # at most mean set size / (HEAVY / 2) tokens
    often = sorted(((r["token"] % 2**64, r["c"]) for r in often))
    heavy = np.array([t for t, _ in often], np.uint64)
    heavy_df = np.array([max(c, 2) for _, c in often], np.int64)
    ranges = max(LEAST_RANGES, math.ceil((total["tokens"] or 0) / RANGE_TOKENS))
    blocks = rows.select("_text").mapInArrow(_blocks(n, ranges, heavy), BLOCK)
    shared = blocks.groupBy("range").applyInPandas(
        _shared(ranges, heavy, heavy_df), "bucket int, kind int, sids binary, counts binary, keys binary")
    sets = stage(shared.groupBy("bucket").applyInPandas(
        _survivors(percent), "sid long, n long, prefix long, central double, keys binary"), "ngram-sets")
    first = stage(members.filter("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("_first")), "ngram-first")
    comps = set_components(sets, percent)
    of_set = first.join(comps, "sid", "left").select("sid", "_first", F.coalesce("comp", "sid").alias("_comp"))
    of_set = stage(of_set, "ngram-comps")
    of_comp = of_set.groupBy("_comp").agg(
        F.min(F.when(F.col("_first").isNotNull(), F.struct(F.col("_first").alias("id"), "sid"))).alias("least"))
    label = of_set.join(of_comp, "_comp").select("sid", "least")
    return members.join(label, "sid", "left").select("doc_id", "n", "sid", "least")


def _with_set(batches):
    """The rows with ``_sid``, the id of their set."""
    for part in batch_slices(batches, "_text"):
        sets = token_sets(part.column("_text").to_pylist())
        sid = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([*part.columns, sid], [*part.schema.names, "_sid"])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each group: that of the least id (of different
    texts under this id, that of the least set id). Rows go by id and set: of an id
    that occurs with several texts each is judged by its own. Rows with the empty
    set and with a null id all stay."""
    spark = docs.sparkSession
    rows = stage(_grouped(docs, id_col, text), "ngram-rows").filter("doc_id is not null")
    rows = rows.withColumn("keep", F.col("n").eqNullSafe(0) | ((F.col("doc_id") == F.col("least.id")) & (F.col("sid") == F.col("least.sid"))))
    by_id = rows.groupBy("doc_id").agg(F.bool_or("keep").alias("some"), F.bool_and("keep").alias("every"), F.count_if(F.col("n") > 0).alias("c"))
    own = "_" * (1 + max(map(len, docs.columns)))  # no column of ``docs``
    by_id = stage(by_id.filter("not every or c > 1").select(F.col("doc_id").alias(own), "some"), "ngram-ids")
    gone, mixed = by_id.filter("not some").select(own), by_id.filter("some").select(own)
    here = F.col(f"`{id_col}`") == F.col(own)
    out = docs.join(maybe_broadcast(gone, gone.count(), 16), here, "left_anti")
    many = mixed.count()
    if not many:  # no id occurs twice
        return out.select(docs.columns)
    # rows of ids that occur more than once and of which some stay: by set, and one of equal ones
    mixed = maybe_broadcast(mixed, many, 16)
    ship_package(spark)
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    several = out.join(mixed, here, "left_semi").select(*named, F.col(id_col).alias("_of_id"), F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in several.schema)
    several = several.mapInArrow(_with_set, f"{schema}, _sid long")
    stays = rows.filter("keep and n > 0").select(F.col("doc_id").alias("_of_id"), F.col("sid").alias("_sid")).distinct()
    empty = several.filter("_sid is null")
    one = several.filter("_sid is not null").join(stays, ["_of_id", "_sid"], "left_semi").dropDuplicates(["_of_id", "_sid"])
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    rest = out.join(mixed, here, "left_anti").select(docs.columns)
    return rest.unionAll(empty.select(*back)).unionAll(one.select(*back))


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))
