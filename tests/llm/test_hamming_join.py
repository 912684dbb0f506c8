import random

import numpy as np
import pytest
from cases import documents, edge_texts, empty, words
from test_ngram_join import family
from test_words import plain

from winnow.llm import hamming_join as H


def groups(texts, percent=80):
    """Brute force: size of the set and least linked index of every text."""
    sets = []
    for t in texts:
        w = plain(t)
        sets.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
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
    return {i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))}


def make_texts():
    rng = random.Random(3)
    texts = edge_texts() + [words(1000 + i, 80) for i in range(30)]
    for seed, (n, size, edits) in enumerate(((60, 120, 12), (25, 60, 8), (10, 400, 60), (8, 12, 1), (6, 5, 1), (9, 3, 1))):
        texts += family(seed + 50, n, size, edits, rng)
    line = words(77, 60)
    texts += [words(2000 + i, 10 + i) + " " + line for i in range(25)] + [line] * 3
    chain = words(88, 300).split()
    texts += [" ".join(chain[i * 12 : i * 12 + 150]) for i in range(12)]
    rng.shuffle(texts)
    return texts


def result(df):
    rows = df.collect()
    return len(rows), {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}


@pytest.mark.parametrize("rounds, cell, block", [(2, 5, 1000), (0, 512, 1 << 18), (0, 512, 700)])
def test_matches_brute_force(spark, monkeypatch, rounds, cell, block):
    monkeypatch.setattr(H, "ROUNDS", rounds)
    monkeypatch.setattr(H, "CELL", cell)
    monkeypatch.setattr(H, "BLOCK", block)
    texts = make_texts()
    assert result(H.near_duplicates(documents(spark, texts))) == (len(texts), groups(texts))


def test_every_pair_within_the_distance_meets_under_a_key():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, H.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(H.SYMBOLS, H.DISTANCE, replace=False)] ^= 1
        x, y = H.keys_of(np.array([a, b]))
        assert set(x) & set(y)
    far = H.keys_of(rng.integers(0, 1 << 16, (2, H.SYMBOLS)).astype(np.uint16))
    assert len(set(far.ravel())) == 2 * H.SYMBOLS


def test_signatures_differ_as_sets_do():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.8, 0.95):
        seen = []
        for _ in range(60):
            both = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            one, two = (np.unique(np.r_[both, rng.integers(0, 2**63, (400 - len(both)) // 2, dtype=np.uint64)]) for _ in range(2))
            x, y = H.signatures([one, two])
            seen.append((x == y).mean())
        assert abs(np.mean(seen) - share) < 0.02


def test_a_key_that_many_classes_of_a_batch_share_loses_none(spark, monkeypatch):
    sig = [[1] * H.SYMBOLS] * 50 + [[2] * H.SYMBOLS] * 2 + [[3] * H.SYMBOLS]
    rows = [((i % 2) << 33 | i, s) for i, s in enumerate(sig)]
    df = spark.createDataFrame(rows, "sid long, sig array<short>").repartition(3)
    posts = df.mapInArrow(H._packed(4), H.PACKED).groupBy("range").applyInPandas(H._shared, "key long, sid long, weight float").collect()
    got = {}
    for r in posts:
        got.setdefault(r["key"], []).append(r["sid"])
    assert sorted(map(len, got.values())) == [2] * H.SYMBOLS + [50] * H.SYMBOLS
    assert all(len(set(v)) == len(v) for v in got.values())


def test_cell_links_count_common_shingles(monkeypatch):
    monkeypatch.setattr(H, "COLUMNS", 16)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 300, 60)
    sets = [(i, i % 3, np.unique(np.where(rng.random(60) < rng.choice([0.02, 0.1, 0.3]), rng.integers(0, 300, 60), base)).astype(np.uint64))
            for i in range(50)]
    got = H._cell_links(sets[:20], sets[20:], 80)
    want = {(a[0], b[1]) for a in sets[:20] for b in sets[20:] if a[1] != b[1] and
            100 * len(np.intersect1d(a[2], b[2])) >= 80 * len(np.union1d(a[2], b[2]))}
    assert {(u, sets[v][1]) for u, v in got} == want and len(got) == len(want) > 5
    assert H._cell_links([(1, 1, np.array([5], np.uint64))], [(2, 2, np.array([6], np.uint64))], 80) == []


def test_templates_short_of_a_link_list_no_pairs(spark, monkeypatch):
    rng = random.Random(6)
    base = words(5, 200).split()
    texts = []
    for i in range(400):  # any two share about 0.7 of their shingles
        w = list(base)
        for k in rng.sample(range(100), 9):
            w[2 * k] = f"x{i}y{k}"
        texts.append(" ".join(w))
    seen = []
    monkeypatch.setattr(H, "confirmed", lambda pairs, *a, f=H.confirmed: (seen.append(pairs.count()), f(pairs, *a))[1])
    rows = H.near_duplicates(documents(spark, texts)).collect()
    want = groups(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: w[1] for i, w in want.items()} and sum(w[2] for w in want.values()) > 200
    assert sum(seen) <= 2 * len(texts)  # contraction only: a hub for each text, twice


def test_edges(spark):
    rows = [(None, words(1, 30)), (5, words(1, 30)), (5, words(1, 30)), (None, None), (7, words(2, 30)), (7, words(3, 30)),
            (8, words(3, 30)), (9, ""), (None, words(4, 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in H.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (7, 7, True), (7, 7, True), (8, 7, False), (9, 9, True),
                          (None, 5, False), (None, None, False), (None, None, False)], key=str)
    assert H.near_duplicates(empty(spark)).count() == 0
