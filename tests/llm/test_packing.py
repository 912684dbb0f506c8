import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import documents, edge_texts, empty, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from winnow.llm import packing as P

TEXTS = edge_texts() + ["a  b \n", " lead\n\n\ntail \n ", "x\u00a0 y\u2003 z\u3000 é w\u0085 v", "'s don't 12 345!!", "<|endoftext|> x", "\x1c a \x1f b", "日本 語 ñ ", "é é\u00a0 é"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def split(texts):
    ids, last = P.encoder(P.VOCABULARY).encode(texts)
    return [ids[a:b].tolist() for a, b in zip([0, *last[:-1]], last)]


def test_ids_are_those_of_the_library(reference):
    assert split(TEXTS) == [reference(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab éÀ\u00a0\u2003\u3000\n\t'1!ß日\x1c\x85", max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert split(texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_and_places(spark, reference):
    texts = TEXTS + [words(i, 20 + i * 13 % 400) for i in range(120)]
    rows = P.packed(documents(spark, texts)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, t in enumerate(texts):
        ids, own = np.array([*reference(t), 0], "<u4"), sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 2048 for r in own[1:]) and (len(own) == 1) == (len(ids) <= 2048)
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 2


def one_by_one(lengths, capacity, max_docs, max_cost):
    """Vector best-fit, a piece at a time."""
    full, weight, bins = np.array([capacity, max_docs, max_cost], float), np.array(P.WEIGHTS), []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n], float)
        fit = [(float((((b - need) / full) ** 2 * weight).sum()), i) for i, b in enumerate(bins) if (b >= need).all()]
        if fit:
            bins[min(fit)[1]] -= need
        else:
            bins.append(full - need)
    return len(bins)


def test_plan_by_classes_packs_as_well_as_one_by_one():
    rng = np.random.default_rng(1)
    for capacity, max_docs, max_cost in ((100, 100, 10_000), (100, 4, 10_000), (100, 100, 3_000)):
        lengths = np.minimum(rng.geometric(0.06, 600), 54).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        steps, bins, used = P.plan(counts, capacity, max_docs, max_cost), defaultdict(list), defaultdict(int)
        for n, low, high, first, per, offset in steps:
            assert low == used[n]
            used[n] = high
            for r in range(low, high):
                bins[first + (r - low) // per].append((offset + (r - low) % per * n, n))
        assert dict(used) == counts
        for own in bins.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= capacity and len(own) <= max_docs and sum(n * n for _, n in own) <= max_cost
        assert len(bins) <= one_by_one(lengths, capacity, max_docs, max_cost) * 1.05 + 1


def test_sequences_round_trip(spark, reference):
    docs = documents(spark, TEXTS)
    ids = P.pieces(docs, keep_ids=True).cache()
    placed = P.pack(ids.drop("ids")).cache()
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in P.sequences(placed, ids).collect()}
    for r in placed.filter("start = 0").collect():
        want = [*reference(TEXTS[r["doc_id"]]), 0][: r["length"]]
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tolist() == want


def test_empty(spark):
    assert P.packed(empty(spark)).count() == 0
