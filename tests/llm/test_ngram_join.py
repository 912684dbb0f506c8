import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from cases import documents, edge_texts, empty, words
from test_words import plain

from winnow.llm import ngram_join as J
from winnow.llm.prefix_tree import PrefixTree, needed


def groups(texts, percent=80):
    """Brute force: size of the set and least linked index of every text."""
    sets = []
    for t in texts:
        w = plain(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def family(seed, n, size, edits, rng):
    """A text and copies with some words changed."""
    first = words(seed, size).split()
    out = []
    for _ in range(n):
        w = list(first)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = words(rng.randrange(10**6), 1)
        out.append(" ".join(w))
    return out


def make_texts():
    rng = random.Random(3)
    texts = edge_texts() + [words(1000 + i, 80) for i in range(30)]
    for seed, (n, size, edits) in enumerate(((40, 120, 3), (25, 60, 4), (10, 400, 20), (8, 12, 1), (6, 5, 1))):
        texts += family(seed + 50, n, size, edits, rng)
    line = words(77, 60)
    texts += [words(2000 + i, 10 + i) + " " + line for i in range(25)] + [line] * 3
    chain = words(88, 300).split()
    texts += [" ".join(chain[i * 12 : i * 12 + 150]) for i in range(12)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("heavy", [J.HEAVY, 0.05])
def test_matches_brute_force(spark, monkeypatch, heavy):
    monkeypatch.setattr(J, "HEAVY", heavy)
    monkeypatch.setattr(J, "CELL", 7)
    texts = make_texts()
    rows = J.similar_groups(documents(spark, texts)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert len(rows) == len(texts) and got == groups(texts)


def test_exhaustion_alone_finds_all(spark, monkeypatch):
    monkeypatch.setattr(J, "ROUNDS", 0)
    texts = make_texts()[:90]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_groups(documents(spark, texts)).collect()}
    assert got == groups(texts)


def test_keep_one(spark):
    texts = make_texts()[:80] + ["", None]
    docs = documents(spark, texts)
    want = {i for i, (n, root) in groups(texts).items() if not n or root == i}
    kept = J.keep_one(docs)
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == docs.columns


def test_templates_short_of_a_link_list_no_pairs(spark, monkeypatch):
    rng = random.Random(6)
    base = words(5, 300).split()
    texts = []
    for i in range(2000):  # any two share about 0.7 of their shingles
        w = list(base)
        for k in rng.sample(range(60), 5):
            w[5 * k] = f"x{i}y{k}"
        texts.append(" ".join(w))
    seen = []
    monkeypatch.setattr(J, "verified", lambda pairs, *a, f=J.verified: (seen.append(pairs.count()), f(pairs, *a))[1])
    rows = J.similar_groups(documents(spark, texts, clash=False)).collect()
    comps = {r["doc_id"]: r["component_id"] for r in rows}
    few = groups(texts[:300])
    assert len(rows) == 2000 and sum(seen) <= 2 * len(texts)  # contraction only: a hub for each text, twice
    assert all(comps[i] == comps[r] for i, (_, r) in few.items()) and len(set(comps.values())) > 1000


def test_edges(spark):
    rows = [(None, words(1, 30)), (5, words(1, 30)), (5, words(1, 30)), (None, None), (7, words(2, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in J.similar_groups(docs).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (7, 7), (None, 5), (None, None)], key=str)
    near = words(9, 60)
    other = near.replace(words(9, 60).split()[-1], "zz")
    same_id = [(3, words(3, 30)), (3, words(4, 30)), (4, words(4, 30)), (6, near), (6, other), (6, near), (2, words(3, 30)), (6, ""), (6, " ")]
    got = sorted((r["doc_id"], r["text"]) for r in J.keep_one(spark.createDataFrame(same_id, "doc_id long, text string").repartition(3)).collect())
    six = [g for g in got if g[0] == 6 and g[1].strip()]
    assert len(six) == 1 and six[0][1] in (near, other)
    assert [g for g in got if g not in six] == [(2, words(3, 30)), (3, words(4, 30)), (6, ""), (6, " ")]
    assert sorted(((r["doc_id"], r["text"]) for r in J.keep_one(docs).collect()), key=str) == sorted(
        [(None, words(1, 30)), (5, words(1, 30)), (None, None), (7, words(2, 30))], key=str)
    assert J.similar_groups(empty(spark)).count() == 0 and J.keep_one(empty(spark)).count() == 0


def test_prefix_tree_search():
    rng = np.random.default_rng(5)
    first = np.sort(rng.choice(300, 80, replace=False))
    sets = [np.unique(np.where(rng.random(80) < rng.choice([0.02, 0.1, 0.3]), rng.integers(0, 300, 80), first)) for _ in range(60)]
    sets += [sets[0], sets[1][:5], first[:0]]
    tree = PrefixTree(sets, np.array([len(s) for s in sets]))
    for probe in (sets[3], first, sets[1][:5]):
        want = {(i, len(np.intersect1d(probe, s))) for i, s in enumerate(sets)
                if len(np.intersect1d(probe, s)) >= needed(len(probe), len(s), 80)}
        assert set(tree.search(probe, len(probe), 80, 300)) == want


def test_a_range_is_counted_in_bounded_memory():
    """A million tokens of one range: what counting them takes beyond the input, and what it finds."""
    rng = np.random.default_rng(8)
    rows, want, owners = [], {}, np.arange(4000)
    for _ in range(8):  # blocks of batches; a set of two batches counts once
        sids = np.sort(rng.choice(owners, 500, replace=False))
        token = rng.integers(0, 1 << 24, (500, 250)).astype(np.uint64) * np.uint64(0x9E3779B1)
        for s, own in zip(sids, token):
            for t in own.tolist():
                want.setdefault(t, set()).add(int(s))
        raw = token.reshape(-1, 1).view(np.uint8)[:, :6]
        rows.append((3, J.PLAIN, sids.astype(np.int64).tobytes(), np.full(500, 250, np.int32).tobytes(), np.ascontiguousarray(raw).tobytes()))
    group = pd.DataFrame(rows, columns=["range", "kind", "sids", "counts", "tokens"])
    run = J._shared(16, np.empty(0, np.uint64), np.empty(0, np.int64))
    tracemalloc.start()
    got = run(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * 10**6, peak
    found = {}
    for bucket, sids, counts, keys in zip(got["bucket"], got["sids"], got["counts"], got["keys"]):
        own = np.repeat(np.frombuffer(sids, np.int64), np.frombuffer(counts, np.int32)).tolist()
        assert all(s % 16 == bucket for s in own)
        for s, key in zip(own, np.frombuffer(keys, np.int64).tolist()):
            found.setdefault(key, set()).add(s)
    assert sorted(map(sorted, found.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)
    assert all(key >> 49 == len(s) for key, s in found.items())
