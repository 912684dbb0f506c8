"""Approximate nearest neighbours (operator 8): a forest of random-projection trees.

Each tree splits its rows at the median of their projection on the difference
of two random rows, down to leaves of about ``LEAF`` rows. Trees are built on a
sample of at most ``SAMPLE`` rows (those of smallest hash); every row is then
put into its leaf of every tree. A query searches all trees through one shared
priority queue, ordered by the least distance to a plane crossed on the way
down, and takes leaves until they hold ``VISIT`` of all rows (counted per tree,
so with repeats) or ``LEAST`` rows. Leaf candidates are then ranked exactly, in
double precision on the original vectors.

Vectors of equal components are one entry with the ids of its ``k`` + 1 least
rows, which is all that ties to the smaller id can need; so a vector that a
third of the rows share is one candidate. Inner products are searched as
distances: each vector gets one more component, which brings all to the length
of the longest. Leaves are joined with the queries that visit them as
(tree, leaf, block) groups of at most ``BLOCK`` rows; each task keeps only the
best ``k`` of a query before the shuffle.

The given vectors have little structure, so the search share sets the recall:
README states the recall measured against brute force. Rows whose vector is
null, zero, or holds a null or a non-finite component take no part; so do those
whose number of components differs from the most common one. Fewer than ``k``
candidates are returned as they are; an id that several rows have is one candidate, with its
best score, and asks with the least of its vectors; a query's own id is no
candidate; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, shuffle_parts, stage, table

TREES, LEAF, SAMPLE = 10, 256, 65_536
VISIT, LEAST = 0.9, 4096
BLOCK = 4096
VISIT_ROWS = 4096  # visits that a task hands on at a time
K, EVERY = 20, 20


def valid(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(finite & F.exists("v", lambda x: x != 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """key, v and the ``k`` + 1 least ids of every different vector."""
    rows = rows.withColumn("key", F.xxhash64("v")).dropDuplicates(["key", "vec_id"])  # repeated rows take no place of other ids
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    near = F.row_number().over(Window.partitionBy("key", "salt").orderBy("vec_id"))
    few = rows.withColumn("_r", near).filter(F.col("_r") <= k + 1)
    return (few.groupBy("key").agg(F.first("v").alias("v"), F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids")))


class Forest:
    """Planes of all trees: per inner node its plane, offset and two children
    (a child below 0 is leaf -child - 1)."""

    def __init__(self, sample: np.ndarray, leaf: int, trees: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            planes, cuts, kids = [], [], []
            leaves = 0
            stack = [(np.arange(len(sample)), None, 0)]
            root = -1
            while stack:
                rows, parent, side = stack.pop()
                split = self._split(sample, rows, rng) if len(rows) > leaf else None
                if split is None:
                    leaves += 1
                    name = -leaves
                else:
                    name = len(planes)
                    planes.append(split[0])
                    cuts.append(split[1])
                    kids.append([0, 0])
                    below = split[2]
                    stack += [(rows[below], name, 0), (rows[~below], name, 1)]
                if parent is None:
                    root = name
                else:
                    kids[parent][side] = name
            width = sample.shape[1]
            self.trees.append((root, np.array(planes).reshape(-1, width), np.array(cuts), np.array(kids, np.int64).reshape(-1, 2), leaves))

    @staticmethod
    def _split(sample, rows, rng):
        for _ in range(8):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            plane = a - b
            norm = np.linalg.norm(plane)
            if not norm:
                continue
            side = sample[rows] @ (plane / norm)
            cut = float(np.median(side))
            below = side <= cut
            if 0 < below.sum() < len(rows):
                return plane / norm, cut, below
        return None

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree (rows x trees)."""
        out = np.zeros((len(x), len(self.trees)), np.int64)
        for t, (root, planes, cuts, kids, _) in enumerate(self.trees):
            at = np.full(len(x), root)
            while (inner := np.flatnonzero(at >= 0)).size:
                node = at[inner]
                side = np.einsum("ij,ij->i", x[inner], planes[node]) > cuts[node]
                at[inner] = kids[node, side.astype(np.int64)]
            out[:, t] = -at - 1
        return out

    def visits(self, q: np.ndarray, sizes: list[np.ndarray], wanted: int) -> list[tuple[int, int]]:
        """(tree, leaf) that a query visits, until they hold ``wanted`` rows."""
        margin = [planes @ q - cuts if len(cuts) else cuts for _, planes, cuts, _, _ in self.trees]
        queue = [(-np.inf, t, tree[0]) for t, tree in enumerate(self.trees)]
        heapq.heapify(queue)
        out, rows = [], 0
        while queue and rows < wanted:
            worst, t, node = heapq.heappop(queue)
            while node >= 0:
                m = margin[t][node]
                near, far = self.trees[t][3][node][::-1] if m > 0 else self.trees[t][3][node]
                heapq.heappush(queue, (max(worst, abs(m)), t, far))
                node = near
            if sizes[t][-node - 1]:
                out.append((t, -node - 1))
                rows += int(sizes[t][-node - 1])
        return out


def _matrix(frame: pd.DataFrame, longest: float) -> np.ndarray:
    """Vectors with the component that makes all as long as the longest."""
    x = np.array(frame["v"].tolist(), float)
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0.0))
    return np.c_[x, rest]


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The best ``k`` different ids of every query, each with its best score."""
    order = np.lexsort((-score, ids, query))
    query, ids, score = query[order], ids[order], score[order]
    new = np.r_[True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])]
    query, ids, score = query[new], ids[new], score[new]
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    rank = np.arange(len(query)) - np.repeat(start, np.diff(np.r_[start, len(query)]))
    keep = rank < k
    return query[keep], ids[keep], score[keep], rank[keep]


def _rank_cells(k: int):
    """Exact inner products of the visits with the rows of their cell (kind 0
    rows come before kind 1 queries); a task returns a query's best ``k``."""

    def run(frames):
        cell, names, rows, best = None, [], [], None

        def score(batch):
            if not rows or not batch:
                return
            x, q = np.array(rows), np.array([v for _, v in batch])
            own = np.array([i for i, _ in batch], np.int64)
            many = np.array([len(n) for n in names])
            flat, lead = np.concatenate(names), np.cumsum(many) - many
            near = q @ x.T
            take, once = k + 1, len(np.unique(flat)) == len(flat)
            while True:
                # the best entries of each query, with all that rounding can't tell from the last
                all_of = take >= len(rows)
                kth = np.full(len(q), -np.inf) if all_of else np.partition(near, len(rows) - take, axis=1)[:, len(rows) - take]
                who, entry = np.nonzero(near >= (np.where(all_of, kth, kth - 1e-9 * (1 + np.abs(kth))))[:, None])
                exact = np.einsum("ij,ij->i", q[who], x[entry])
                n = many[entry]
                at = np.repeat(lead[entry] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                ids, asker, value = flat[at], np.repeat(who, n), np.repeat(exact, n)
                other = ids != own[asker]
                ids, asker, value = ids[other], asker[other], value[other]
                # an id may have several entries: more of them until every query has k ids
                if all_of or once or np.bincount(np.unique(np.stack([asker, ids]), axis=1)[0], minlength=len(q)).min() >= k:
                    break
                take *= 2
            waiting.append((own[asker], ids, value))
            if sum(len(w[0]) for w in waiting) > 500_000:
                settle()

        waiting = []

        def settle():
            nonlocal best
            if waiting:
                parts = ([best] if best is not None else []) + waiting
                best = _best(*[np.concatenate(z) for z in zip(*parts)], k)[:3]
                waiting.clear()

        for frame in frames:
            batch = []
            for tree, leaf, block, kind, ids, v in frame[["tree", "leaf", "block", "kind", "ids", "v"]].itertuples(index=False):
                if (tree, leaf, block) != cell:
                    score(batch)
                    cell, names, rows, batch = (tree, leaf, block), [], [], []
                if kind == 0:
                    names.append(np.asarray(ids, np.int64))
                    rows.append(v)
                else:
                    batch.append((int(ids[0]), v))
            score(batch)
        settle()
        if best is not None and len(best[0]):
            yield pd.DataFrame({"query_id": best[0], "vec_id": best[1], "score": best[2]})

    return run


def nearest(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector: str = "embedding", trees: int = TREES,
            leaf: int = LEAF, sample: int = SAMPLE, visit: float = VISIT) -> DataFrame:
    """query_id, rank, vec_id and score of the best ``k`` found for each row where ``is_query`` (of vec_id) holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = valid(vectors, id_col, vector)
    width = [r["w"] for r in rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()]
    rows = rows.filter(F.size("v") == (width[0] if width else 0))
    schema = "query_id long, rank int, vec_id long, score double"
    different = stage(entries(rows, k), "ann-entries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, longest = different.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], schema)
    picked = different.orderBy(F.xxhash64("key"), "key").limit(sample).select("v").toPandas()
    # a leaf of the sample stands for n / sample as many rows
    forest = Forest(_matrix(picked, longest), max(8, leaf * min(n, sample) // n), trees)
    shared = spark.sparkContext.broadcast(forest)

    def put(frames):
        for frame in frames:
            if not len(frame):
                continue
            at = shared.value.leaves(_matrix(frame, longest))
            for t in range(at.shape[1]):
                yield pd.DataFrame({"tree": t, "leaf": at[:, t], "key": frame["key"], "ids": frame["ids"], "v": frame["v"]})

    placed = different.mapInPandas(put, "tree int, leaf long, key long, ids array<long>, v array<double>")
    counts = stage(placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")), "ann-leaves")
    sizes = [np.zeros(t[4], np.int64) for t in forest.trees]
    for r in counts.collect():  # at most trees * sample / 8 leaves
        sizes[r["tree"]][r["leaf"]] = r["n"]
    blocks = [-(-s // BLOCK) for s in sizes]
    wanted = max(LEAST, int(visit * n))
    plan = spark.sparkContext.broadcast((sizes, blocks))

    cells_of = ["tree", "leaf", "block", "ids", "v"]

    def look(frames):
        sizes, blocks = plan.value
        for frame in frames:
            if not len(frame):
                continue
            x, raw = _matrix(frame, longest), frame["v"].tolist()
            x[:, -1] = 0.0  # a query has no share of the added component
            out = []
            for own, q, v in zip(frame["vec_id"], x, raw):
                for t, leaf_no in shared.value.visits(q, sizes, wanted):
                    out += [(t, leaf_no, b, [own], v) for b in range(blocks[t][leaf_no])]
                if len(out) >= VISIT_ROWS:  # every visit carries the query's vector
                    yield pd.DataFrame(out, columns=cells_of)
                    out = []
            yield pd.DataFrame(out, columns=cells_of)

    def blocked(frames):
        blocks = plan.value[1]
        for frame in frames:
            if not len(frame):
                continue
            many = np.array([blocks[t][i] for t, i in zip(frame["tree"], frame["leaf"])])
            yield frame.assign(block=(frame["key"].to_numpy() % many).astype(np.int32))[cells_of]

    cells = "tree int, leaf long, block int, ids array<long>, v array<double>"
    members = placed.mapInPandas(blocked, cells).withColumn("kind", F.lit(0))
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(shuffle_parts(spark), "vec_id").mapInPandas(look, cells).withColumn("kind", F.lit(1))
    cell = ["tree", "leaf", "block"]
    dealt = members.unionByName(queries).repartition(2 * shuffle_parts(spark), *cell).sortWithinPartitions(*cell, "kind")
    found = dealt.mapInPandas(_rank_cells(k), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_random_projection_forest(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
