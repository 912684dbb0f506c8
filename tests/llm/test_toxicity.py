import numpy as np
from cases import documents, edge_texts, empty, words

from winnow.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def labels(spark, rows):
    return spark.createDataFrame([(i, 1, t) for i, t in rows], LABELS)


def made(n=900):
    """Texts of which a fifth hold one of twelve invented insults."""
    bad = [f"zorb{c}x" for c in "abcdef"] + ["grumf", "plott", "snarg", "vrekk", "dwill", "hamph"]
    texts, toxic = [], []
    for i in range(n):
        w = words(10_000 + i, 30 + i % 20).split()
        if i % 5 == 0:
            w[i % 30] = bad[i // 5 % 12].upper() if i % 2 else bad[i // 5 % 12] + "."
        texts.append(" ".join(w))
        toxic.append(int(i % 5 == 0))
    return texts, toxic


def test_learnt_words_reach_held_out_rows(spark):
    texts, toxic = made()
    docs = documents(spark, texts)
    grammar = T.fit(docs, labels(spark, enumerate(toxic)))
    assert {"grumf", "plott"} <= set(grammar.whole) and any(p.startswith("zorb") for p in grammar.begin)
    rows = {r["doc_id"]: r["score"] for r in T.score(docs, grammar).collect()}
    hits = [(rows[i] >= 0.5) == bool(t) for i, t in enumerate(toxic)]
    assert np.mean(hits) > 0.97 and all(0 <= s <= 1 for s in rows.values())
    new = documents(spark, [words(1, 20) + " ZorbFx " + words(2, 9), words(3, 40)] + edge_texts())
    got = {r["doc_id"]: r["score"] for r in T.score(new, grammar).collect()}
    assert got[0] >= 0.5 > got[1] and len({got[i] for i in (1, 2, 3, 4)}) == 1
    kept = T.reject(new, grammar)
    assert {r["doc_id"] for r in kept.collect()} == set(range(1, 2 + len(edge_texts()))) and kept.columns == new.columns


def test_held_out_labels_are_not_used(spark):
    import zlib
    texts, toxic = made(300)
    docs = documents(spark, texts)
    one = T.fit(docs, labels(spark, enumerate(toxic)))
    other = T.fit(docs, labels(spark, [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in enumerate(toxic)]))
    assert one.whole == other.whole and one.begin == other.begin and np.allclose(one.path, other.path) and one.bias == other.bias


def test_clauses_are_scored_by_their_path():
    g = T.Grammar({"idiot": 2.0, "moron": 1.0}, {"zorb": 3.0}, 0.0, [1.0] * len(T.PATHS))

    def paths(text):
        return {p: w for p, w in zip(T.PATHS, g.clause(text)) if w}

    assert paths("an idiot here") == {"insult": 2.0}
    assert paths("you are an idiot") == {"insult aimed": 2.0}
    assert paths("idiot that you are") == {"insult aimed": 2.0}
    assert paths("that is not an idiot") == {"insult denied": 2.0}
    assert paths("somebody said idiot") == {"insult reported": 2.0}
    assert paths('the word "moron" is old') == {"insult reported": 1.0}
    assert paths("you we kill") == {"threat aimed": 1.0}
    assert paths("zorbing zorb") == {"insult": 3.0}
    assert paths("I will kill them") == {"threat aimed": 1.0}
    assert paths("I will not kill you") == {"threat denied": 1.0}
    assert paths("will kill") == {"threat meant": 1.0}
    assert paths("you don't look like an idiot") == paths("you don’t look like an idiot") == {"insult denied": 2.0}
    assert paths("nobody is an idiot") == {"insult denied": 2.0}
    assert paths("he wrote that he will hurt us") == {"threat reported": 1.0}
    assert paths("kill the lights") == {} and paths("we burn it and kill you") == {"threat aimed": 1.0}
    assert paths("what a waste of space you are") == {"insult aimed": T.PHRASE} and paths("a piece of a piece of trash") == {"insult": T.PHRASE}
    assert paths("not a waste of space") == {"insult denied": T.PHRASE} and paths("a waste of time and space") == {}
    assert paths("we will come for you") == {"threat aimed": 1.0}
    assert paths("idiot and will kill, you") == {"insult": 2.0, "threat aimed": 1.0}
    texts = ["Fine. You idiot! Fine", "fine", None, "", "IDIOT\nnot a moron; x", "zorbery"]
    x = g.features(texts)
    assert x[0].any() and not x[1].any() and not x[2].any() and x[4].sum() > x[0].sum() and x[5].any()


def test_composition_is_the_cascade():
    import random
    rng, arcs = random.Random(1), T.compose()
    for _ in range(300):
        states, whole = [0] * len(T.CASCADE), (0,) * len(T.CASCADE)
        for s in rng.choices(T.INPUTS, k=12):
            whole, out = arcs[whole, s]
            for i, (step, n) in enumerate(T.CASCADE):
                states[i], s = step(states[i], s)
                assert 0 <= states[i] < n
            assert (whole, out) == (tuple(states), s)


def test_fast_features_equal_the_score_of_every_clause():
    """The clauses that the vectorised search skips have no weight."""
    import random
    import re
    rng = random.Random(7)
    g = T.Grammar({"idiot": 2.0, "moron": 1.0, "élan": 1.5}, {"zorb": 3.0}, 0.0, [1.0] * len(T.PATHS))
    pool = [*T.INSULT_PHRASES, *T.THREAT_PHRASES, *T.THREATS, *T.TARGETS, *T.INTENT, *T.NEGATIONS, *T.REPORTS, "idiot", "moron", "Élan", "zorbing", "zorb",
            "zorbä", "don't", "plain", "word", "of", "a", "space", '"', "123", "x_y", "up"]
    texts = [" ".join(rng.choice([x, x.upper(), x]) + rng.choice(["", "", "", ".", "!", ";", "\n", ","]) for x in rng.choices(pool, k=40)) for _ in range(300)]
    texts += [None, "", "...", "idiot", "a.idiot!b"]
    want = np.array([sum((g.clause(c) for c in re.split(r"[.!?;\n]", t or "")), np.zeros(len(T.PATHS))) for t in texts])
    assert np.allclose(g.features(texts), np.log1p(np.maximum(want, 0)))
    assert (want != 0).any(0).all()


def test_no_labels_and_empty(spark):
    docs = documents(spark, ["you idiot", "fine"] + edge_texts())
    grammar = T.fit(docs, labels(spark, []))
    got = {r["doc_id"]: r["score"] for r in T.score(docs, grammar).collect()}
    assert got[0] > got[1] and len(got) == 2 + len(edge_texts())
    assert T.score(empty(spark), grammar).count() == 0 and T.reject(empty(spark), grammar).count() == 0
    assert T.fit(empty(spark), labels(spark, [(1, 1)])).bias == grammar.bias


def test_paths_without_labels_keep_their_prior():
    rng = np.random.default_rng(1)
    x = np.c_[np.ones(400), rng.integers(0, 2, 400) * 2.0, np.zeros(400)]
    w = T.logistic(x, x[:, 1] > 0, np.array([0.0, 2.0, 3.0]))
    assert abs(w[2] - 3.0) < 1e-6 and w[1] > 2 and w[0] < -1
    low = T.logistic(x, x[:, 1] == 0, np.array([0.0, 2.0, 3.0]))
    assert low[1] == 0.0 and abs(low[2] - 3.0) < 1e-6
