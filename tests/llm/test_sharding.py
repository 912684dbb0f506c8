import zlib
from collections import defaultdict

from cases import documents, edge_texts, empty, words

from winnow.llm import sharding


def smallest(sizes, shards):
    """Brute-force minimax of contiguous runs."""
    best = [[0] + [float("inf")] * len(sizes)]
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    for _ in range(shards):
        last = best[-1]
        best.append([min(max(last[j], total[i] - total[j]) for j in range(i + 1)) for i in range(len(sizes) + 1)])
    return best[-1][-1]


def check(rows, shards, texts):
    members, atoms = defaultdict(list), {}
    for r in rows:
        assert 0 <= r["shard"] < shards
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
        members[r["shard"]].append(r)
        assert atoms.setdefault(raw, r["shard"]) == r["shard"]
    for own in members.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return max(sum(r["size"] for r in own) for own in members.values())


def test_capacity_is_minimal(spark):
    texts = [words(i % 60, 3 + i * 7 % 50) for i in range(150)] + edge_texts()[:7]
    docs = documents(spark, texts)
    for shards in (1, 5, 24):
        rows = sharding.shard(docs, shards).collect()
        heaviest = check(rows, shards, texts)
        line = sorted((r["_h"], r["s"]) for r in sharding.sized(docs).groupBy("_h").sum("size").toDF("_h", "s").collect())
        assert len(rows) == len(texts) and heaviest == smallest([s for _, s in line], shards)


def test_levels_are_refined(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 8)
    atoms = spark.range(0, 3000).selectExpr("xxhash64(id) >> 40 as _h", "id % 97 + 1 as size")
    line = sorted((r["_h"], r["s"]) for r in atoms.groupBy("_h").sum("size").toDF("_h", "s").collect())
    capacity, cuts = sharding.minimax_cuts(atoms, 7)
    low, high = 0, sum(s for _, s in line)
    while low < high:
        mid, used, load = (low + high) // 2, 1, 0
        for _, s in line:
            used, load = (used, load + s) if load + s <= mid else (used + 1, s)
        low, high = (low, mid) if used <= 7 and max(s for _, s in line) <= mid else (mid + 1, high)
    assert capacity == low and cuts == sorted(cuts)


def test_hot_group_and_empty(spark):
    texts = ["same text " * 50] * 40 + [words(i, 5) for i in range(30)]
    check(sharding.shard(documents(spark, texts), 24).collect(), 24, texts)
    assert sharding.shard(empty(spark), 24).count() == 0
