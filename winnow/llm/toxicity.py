"""Toxicity (operator 10): a weighted finite-state pattern grammar over clauses.

A text is cut into clauses at ``. ! ? ;`` and line ends. A first transducer reads
words and writes symbols: insult, threat, intent, target, negation, report, other. It
knows single words, word beginnings and phrases (a trie with failure arcs; a phrase
writes its symbol at its last word). Four sequential transducers follow in cascade:
*negation* marks insults and threats shortly after a negation, *purpose* marks threats
shortly after an intent, *report* marks what follows a verb of saying or stands in
quotation marks, *target* marks insults and threats near a person addressed, before or
after them. Their composition is tabulated once; each clause it matches adds its
weight to the class of its path, so the same word counts differently when denied,
meant, reported or aimed at somebody.

Short public lists seed insults and threats; more insults, and all weights, are
learnt from labelled rows:
patterns whose share in toxic rows is far above that in clean ones (copies
count once), then a logistic regression over the clause classes. The fit uses
at most ``MAX_LABELLED`` labelled rows, those of smallest hash; everything else
covers all rows. Labels are never inputs of a score.

Edge cases: null and empty texts have no clause and get the score of a text
without a match; texts are read whole; without labelled rows the seeds alone
decide; repeated rows score alike; a doc_id labelled twice counts as toxic if
either label says so; other columns are ignored by ``score`` and kept by
``reject``.
"""

from __future__ import annotations

import math
import re
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import batch_slices, ship_package, stage, table, text_chunks

MAX_LABELLED = 20_000  # labelled rows that the fit uses at most
SLICE = 3 << 20  # bytes of text scored at once
MIN_TOXIC = 4  # different toxic rows that a learnt pattern needs
MIN_WORDS = 4  # different words that a learnt beginning needs
PREFIXES = (4, 5, 6, 7, 8)  # bytes of a word beginning

# Seed words, all lower case.
INSULTS = ("asshole", "bastard", "bitch", "clown", "disgusting", "dumb", "fool", "idiot", "imbecile", "jerk", "loser",
           "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless")
INSULT_PHRASES = ("piece of trash", "piece of garbage", "waste of space", "waste of air", "go to hell", "shut up", "get lost", "drop dead",
                  "no one likes you", "sack of garbage", "good for nothing", "lowest of the low")
THREATS = ("kill", "hurt", "destroy", "shoot", "stab", "burn", "hang", "beat", "töten", "tuer", "matar")
INTENT = ("will", "gonna", "shall", "must", "should", "werde", "vais", "voy")
TARGETS = ("you", "your", "yours", "u", "he", "she", "him", "her", "they", "them", "du", "dich", "ihr", "tu", "toi",
           "vous", "tú", "usted", "ustedes", "ellos")
THREAT_PHRASES = ("come for", "going to get", "gonna get", "beat up", "watch your back", "make you pay", "make them pay", "hunt down",
                  "wipe out", "cut your throat", "break your neck")
NEGATIONS = ("not", "never", "no", "isn", "aren", "wasn", "nicht", "kein", "nie", "pas", "jamais", "nunca", "ni", "nobody", "none",
             "nothing", "neither", "nor", "without", "hardly", "niemand", "keiner", "keine", "personne", "nadie")
REPORTS = ("said", "says", "say", "wrote", "writes", "called", "calls", "claimed", "quoted", "reported", "sagte",
           "dit", "dijo")
SYMBOLS = {"threat": THREATS, "intent": INTENT, "target": TARGETS, "negation": NEGATIONS, "report": REPORTS}
WORD_SYMBOL = {w: s for s, ws in SYMBOLS.items() for w in ws}

CLAUSE_END = re.compile(rb"[.!?;\n]")
TOKEN = re.compile(r"[^\W\d_]+n['’]t\b|[^\W\d_]+|[\"“”«»]")
CONTRACTED = ("n't", "n’t")  # a word that ends so is a negation
PHRASE = 2.0  # weight of an insult that is a phrase
REACH = 4  # words over which a negation, an intent or a target works
PATHS = ("insult", "insult aimed", "insult denied", "insult reported", "threat meant", "threat aimed", "threat denied", "threat reported")
# weights of the paths before any label is seen; the fit is drawn to them where labels say nothing
PRIOR = (2.0, 3.0, 0.5, 0.5, 1.0, 3.0, 0.2, 0.5)


# --- transducers: (state, symbol) -> (state, output symbol) ---------------------------------------------------------

def phrases() -> tuple[dict[tuple[int, str], int], list[int], list[str | None]]:
    """The first transducer's phrases: arcs of their trie, for each state the longest
    other beginning that it ends with, and what the state writes."""
    arcs, back, out = {}, [0], [None]
    for symbol, known in (("insult", INSULT_PHRASES), ("threat", THREAT_PHRASES)):
        for phrase in known:
            at = 0
            for word in phrase.split():
                if (at, word) not in arcs:
                    arcs[at, word] = len(out)
                    back.append(0)
                    out.append(None)
                at = arcs[at, word]
            out[at] = symbol
    for (state, word), after in sorted(arcs.items(), key=lambda x: x[1]):  # beginnings before what they lead to
        if state:
            fall = back[state]
            while fall and (fall, word) not in arcs:
                fall = back[fall]
            back[after] = arcs.get((fall, word), 0)
            out[after] = out[after] or out[back[after]]
    return arcs, back, out


def negation(state: int, symbol: str) -> tuple[int, str]:
    """State: words for which a negation still works."""
    if symbol == "negation":
        return REACH, symbol
    if symbol in ("insult", "threat") and state:
        return state - 1, symbol + " denied"
    return max(0, state - 1), symbol


def purpose(state: int, symbol: str) -> tuple[int, str]:
    """State: words for which an intent still works."""
    if symbol == "intent":
        return REACH, "other"
    if symbol == "threat" and state:
        return state - 1, "threat meant"
    return max(0, state - 1), symbol


def report(state: int, symbol: str) -> tuple[int, str]:
    """State 1 after a verb of saying, 2 inside quotation marks."""
    if symbol == "quote":
        return (0 if state == 2 else 2), "other"
    if symbol == "report":
        return max(state, 1), symbol
    if state and symbol in ("insult", "threat", "threat meant"):
        return state, symbol.split()[0] + " reported"
    return state, symbol


def target(state: int, symbol: str) -> tuple[int, str]:
    """States 0 to REACH: words for which a target still works; the next REACH: the
    same after an unaimed insult, the last REACH: after an unaimed threat."""
    kind, left = (0, state) if state <= REACH else ((state - 1) // REACH, (state - 1) % REACH + 1)
    if symbol == "target":
        return REACH, ("other", "insult aimed later", "threat aimed later")[kind]
    if symbol in ("insult", "threat", "threat meant"):
        if not kind and left:
            return left - 1, symbol.split()[0] + " aimed"
        return (2 if symbol == "insult" else 3) * REACH, symbol
    return (kind * REACH + left - 1 if left > 1 else 0), symbol


INPUTS = ("insult", "threat", "intent", "target", "negation", "report", "quote", "other")
CASCADE = ((negation, REACH + 1), (purpose, REACH + 1), (report, 3), (target, 3 * REACH + 1))  # transducers and their numbers of states


def compose() -> dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], str]]:
    """The cascade as one table over its product states."""
    arcs = {}
    for *states, symbol in product(*[range(n) for _, n in CASCADE], INPUTS):
        now, after = symbol, []
        for (step, _), state in zip(CASCADE, states):
            state, now = step(state, now)
            after.append(state)
        arcs[tuple(states), symbol] = tuple(after), now
    return arcs


class Grammar:
    """Insult patterns with weights, and the weights of the paths."""

    def __init__(self, whole: dict[str, float], begin: dict[str, float], bias: float, path: list[float]):
        self.bias, self.path = bias, np.array(path)
        self.arcs = compose()
        self.whole, self.begin, self.phrase = whole, begin, phrases()
        last = {p.split()[-1] for p in (*INSULT_PHRASES, *THREAT_PHRASES)}
        self.whole_keys = np.unique(_hashes([*whole, *THREATS, *last]))
        self.begin_keys = {n: np.sort(_hashes([w for w in begin if len(w.encode()) == n])) for n in PREFIXES}

    def weight(self, word: str) -> float:
        if word in self.whole:
            return self.whole[word]
        raw = word.encode()
        return max((self.begin.get(raw[:n].decode("utf-8", "ignore"), 0.0) for n in PREFIXES if len(raw) > n), default=0.0)

    def clause(self, text: str) -> np.ndarray:
        """Weight of every path in one clause."""
        arcs, back, writes = self.phrase
        out, state, place = np.zeros(len(PATHS)), (0,) * len(CASCADE), 0
        waiting: dict[str, tuple[str | None, float]] = {}  # path and weight of the last unaimed insult and threat
        for token in TOKEN.findall(text.lower()):
            while place and (place, token) not in arcs:
                place = back[place]
            place = arcs.get((place, token), 0)
            weight = self.weight(token)
            if weight:
                symbol = "insult"
            elif writes[place]:
                symbol, weight = writes[place], PHRASE
            elif token.endswith(CONTRACTED):
                symbol = "negation"
            else:
                symbol = WORD_SYMBOL.get(token, "other" if token[0].isalpha() else "quote")
            weight = 1.0 if symbol == "threat" else weight
            state, got = self.arcs[state, symbol]
            if got.endswith(" later"):
                kind = got.split()[0]
                path, waits = waiting.pop(kind, (None, 0.0))
                if path:
                    out[PATHS.index(path)] -= waits
                out[PATHS.index(f"{kind} aimed")] += waits
            elif got in PATHS or got == "threat":
                path = got if got in PATHS else None  # a threat that is neither meant nor aimed counts only if it is aimed later
                if path:
                    out[PATHS.index(path)] += weight
                if got in ("insult", "threat", "threat meant"):
                    waiting[got.split()[0]] = path, weight
        return out

    def features(self, texts: list) -> np.ndarray:
        """Weights of the paths of every text, one row each."""
        out = np.zeros((len(texts), len(PATHS)))
        buf, ends = W.joined(texts)
        start, end, keys = letter_words(buf)
        hit = np.isin(keys, self.whole_keys)
        for n, wanted in self.begin_keys.items():
            if len(wanted):
                long = np.flatnonzero(end - start > n)
                hit[long[np.isin(W.hash_spans(folded(buf), start[long], start[long] + n), wanted)]] = True
        raw, done = buf.tobytes(), -1
        for i in np.flatnonzero(hit):
            if start[i] < done:
                continue
            doc = int(np.searchsorted(ends, start[i], "right"))
            low = int(ends[doc - 1]) if doc else 0
            head = low
            for mark in (b".", b"!", b"?", b";", b"\n"):
                head = max(head, raw.rfind(mark, low, int(start[i])) + 1)
            tail = CLAUSE_END.search(raw, int(end[i]), int(ends[doc]))
            done = tail.start() if tail else int(ends[doc])
            out[doc] += self.clause(raw[head:done].decode("utf-8", "replace"))
        return np.log1p(np.maximum(out, 0.0))

    def scores(self, texts: list) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.bias + self.features(texts) @ self.path)))


def folded(buf: np.ndarray) -> np.ndarray:
    """The bytes with the capitals of U+00C0 to U+00DE made small (A-Z are
    already equal under the word hash)."""
    two = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
    if not len(two):
        return buf
    out = buf.copy()
    out[two] += 0x20
    return out


def letter_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every run of letters."""
    start, end = W.word_bounds(buf, W.NOT_LETTER)
    return start, end, W.hash_spans(folded(buf), start, end)


def _hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for i, w in enumerate(words):
        raw = np.frombuffer(w.encode(), np.uint8)
        out[i] = W.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]
    return out


# --- learning -----------------------------------------------------------------------------------------------------

def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text: str, limit: int = MAX_LABELLED) -> DataFrame:
    """text, toxic and ``_copy`` (rows that share it count once) of at most
    ``limit`` labelled rows outside the held-out fifth, by smallest hash."""
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
           .groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    return rows.join(F.broadcast(ids), "doc_id").select("_text", "_toxic")


def _patterns(frames):
    """(pattern, kind, word, copy) of toxic rows: every word and word beginning."""
    for frame in frames:
        for part in text_chunks(frame, "_text", 2 << 20):
            for t in part["_text"]:
                found = set()
                for w in set(re.findall(r"[^\W\d_]+", (t or "").lower())):
                    found.add((w, 0, w))
                    raw = w.encode()
                    for n in PREFIXES:
                        if len(raw) > n and raw[n] & 0xC0 != 0x80:
                            found.add((raw[:n].decode(), n, w))
                key = copy_key(t)
                if found:
                    yield pd.DataFrame([(p, n, w, key) for p, n, w in found], columns=["pattern", "kind", "word", "copy"])


def copy_key(text: str | None) -> int:
    """Equal for copies and, mostly, for near copies: the least hash of the
    text's five-word runs."""
    _, _, _, keys, _ = W.batch_words([text])
    s = W.shingles(keys, 5)
    return int(s.min() >> np.uint64(1)) if len(s) else 0


def _counts(keys: dict[int, np.ndarray], toxic_only: bool = False):
    """Counts candidate patterns in clean rows, given their hashes by kind."""

    def run(frames):
        for frame in frames:
            got = []
            for part in text_chunks(frame, "_text"):
                texts = part["_text"].tolist()
                buf, ends = W.joined(texts)
                start, end, whole = letter_words(buf)
                small = folded(buf)
                doc = np.searchsorted(ends, start, "right")
                for kind, wanted in keys.items():
                    at = np.arange(len(start)) if not kind else np.flatnonzero(end - start > kind)
                    h = whole if not kind else W.hash_spans(small, start[at], start[at] + kind)
                    hit = np.isin(h, wanted)
                    pair = np.unique(np.stack([h[hit], doc[at][hit].astype(np.uint64)], 1), axis=0)
                    k, n = np.unique(pair[:, 0], return_counts=True)
                    got.append(pd.DataFrame({"key": k.view(np.int64), "kind": kind, "n": n.astype(np.int64)}))
            if got:
                yield pd.concat(got)

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
        limit: int = MAX_LABELLED) -> Grammar:
    """Learn patterns and weights from the labelled rows."""
    ship_package(docs.sparkSession)
    rows = stage(labelled(docs, labels, id_col, text, limit), "toxic-labelled")
    toxic, clean = rows.filter("_toxic = 1").select("_text"), rows.filter("_toxic <> 1").select("_text")
    n_toxic, n_clean = toxic.count(), clean.count()
    seeds = Grammar({w: 3.0 for w in INSULTS}, {}, -3.0, list(PRIOR))
    if not n_toxic or not n_clean:
        return seeds
    found = (toxic.mapInPandas(_patterns, "pattern string, kind int, word string, copy long")
             .groupBy("pattern", "kind").agg(F.count_distinct("copy").alias("n"), F.count_distinct("word").alias("words"))
             .filter((F.col("n") >= MIN_TOXIC) & ((F.col("kind") == 0) | (F.col("words") >= MIN_WORDS)))
             .orderBy(F.desc("n"), "kind", "pattern").collect())  # of at most ``limit`` rows: the sample bounds them
    keys = {k: _hashes([r["pattern"] for r in found if r["kind"] == k]) for k in {r["kind"] for r in found}}
    counted = {(r["key"] % 2**64, r["kind"]): r["n"] for r in
               clean.mapInPandas(_counts({k: np.sort(v) for k, v in keys.items()}), "key long, kind int, n long")
               .groupBy("key", "kind").agg(F.sum("n").alias("n")).collect()}
    whole, begin = {}, {}
    for kind, hashes in keys.items():
        for r, h in zip([r for r in found if r["kind"] == kind], hashes):
            other = counted.get((int(h), kind), 0)
            odds = math.log((r["n"] + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_clean + 1))
            if _wilson(r["n"], r["n"] + other) >= 0.5:
                (begin if kind else whole)[r["pattern"]] = odds
    for w in INSULTS:
        whole.setdefault(w, 3.0)
    grammar = Grammar(whole, begin, -3.0, list(PRIOR))
    got = rows.mapInPandas(_features(grammar), "x array<double>, toxic int").toPandas()
    x = np.array(got["x"].tolist()).reshape(-1, len(PATHS))
    weights = logistic(np.c_[np.ones(len(x)), x], got["toxic"].to_numpy() == 1, np.array([0.0, *PRIOR]))
    return Grammar(whole, begin, weights[0], list(weights[1:]))


def _features(grammar: Grammar):
    def run(frames):
        for frame in frames:
            for part in text_chunks(frame, "_text"):
                yield pd.DataFrame({"x": list(grammar.features(part["_text"].tolist())),
                                    "toxic": part["_toxic"].to_numpy()})

    return run


def _wilson(k: int, n: int, z: float = 1.64) -> float:
    """Lower end of the confidence interval of the share k of n."""
    p = k / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression with a ridge around ``prior`` by Newton steps; column 0
    is the constant. No path weight is negative: a match never makes a text cleaner."""
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    bound = np.arange(x.shape[1]) > 0

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - z[y].sum() + (penalty * (w - prior) ** 2).sum() / 2)

    w = prior.copy()
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * (w - prior)
        h = (x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9)
        free = ~(bound & (w <= 0) & (g > 0))
        move = np.zeros(len(w))
        move[free] = np.linalg.solve(h[np.ix_(free, free)], g[free])
        size = 1.0
        while True:  # shorter steps until the loss falls
            new = np.where(bound, np.maximum(w - size * move, 0.0), w - size * move)
            after = loss(new)
            if after <= now or size < 1e-6:
                break
            size /= 2
        done = np.abs(new - w).max() < 1e-8 or size < 1e-6
        w, now = (new, after) if after <= now else (w, now)
        if done:
            break
    return w


# --- scoring ------------------------------------------------------------------------------------------------------

def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    ship_package(docs.sparkSession)

    def run(batches):
        for part in batch_slices(batches, "_text", SLICE):
            got = pa.array(grammar.scores(part.column("_text").to_pylist()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), got], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def reject(docs: DataFrame, grammar: Grammar, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is under ``least``, as they are."""
    ship_package(docs.sparkSession)

    def run(batches):
        for part in batch_slices(batches, text, SLICE):
            yield part.filter(pa.array(grammar.scores(part.column(text).to_pylist()) < least))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
