import hashlib
import itertools
import random
import re
import zlib

import pytest

from winnow.llm import conversation_repair as R
from winnow.llm import hirschberg

GOAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    """Fault of each row (role, text), counted afresh."""
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def every_edit(rows, marks, inserts):
    """All edit scripts with at most ``inserts`` inserts in a row: (cost, audit, repaired)."""
    gaps = ["".join(g) for k in range(inserts + 1) for g in itertools.product("ua", repeat=k)]
    choices = [["D"] if m in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for m in marks]
    for picked in itertools.product(*choices):
        for filled in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i, gap in enumerate(filled):
                for c in gap:
                    cost, audit = cost + 3, audit + "I"
                    out.append(({"u": "user", "a": "assistant"}[c], ""))
                if i < len(rows):
                    role, text = rows[i]
                    audit += picked[i][0]
                    if picked[i] == "D":
                        cost += 4
                        continue
                    cost += 3 * (marks[i] == "truncated") + 3 * (picked[i][0] == "R")
                    out.append((role if picked[i] == "K" else {"u": "user", "a": "assistant"}[picked[i][1]], text))
            if GOAL.match("".join(r[:1] for r, _ in out)):
                yield cost, audit, out


def least(rows):
    """The best (cost, audit, repaired) by a table of whole scripts for every state."""
    marks = faults(rows)
    step = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
    now = {"": (0, "", ())}

    def inserted(at):
        for _ in range(3):
            for p, (c, w, o) in list(at.items()):
                q, r = ("a", "assistant") if p == "u" else ("u", "user")
                way = (c + 3, w + "I", (*o, (r, "")))
                at[q] = min(at.get(q, way), way, key=lambda x: x[:2])
        return at

    for (role, text), m in zip(rows, marks):
        new = {}
        for p, (c, w, o) in inserted(dict(now)).items():
            more = 3 * (m == "truncated")
            ways = [(p, (c + 4, w + "D", o))]
            if m not in ("blank", "duplicate"):
                q, r = ("a", "assistant") if p == "u" else ("u", "user")
                ways.append((q, (c + 3 + more, w + "R", (*o, (r, text)))))
                kept = p if role == "" else step.get(role[0], {}).get(p)
                if kept is not None:
                    ways.append((kept, (c + more, w + "K", (*o, (role, text)))))
            for q, way in ways:
                new[q] = min(new.get(q, way), way, key=lambda x: x[:2])
        now = new
    return min((x for p, x in inserted(dict(now)).items() if p in ("", "a")), key=lambda x: x[:2])


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    return [(rng.choice(roles), rng.choice(["Hi.", "What?", "cut", "", " ", "Go!", f"{rng.random()}."])) for _ in range(n)]


def solved(rows):
    marks = faults(rows)
    said = [(i, r, t, m, 1) for i, ((r, t), m) in enumerate(zip(rows, marks))]
    ways, state = R.words("".join(R.symbol(x[1], x[3]) for x in said if x[3] not in ("blank", "duplicate")), R.NOTHING, R.END)
    return [*R._edits(iter(said), ways, R.NOTHING), *R._closing(state)]


def test_every_script_of_small_conversations():
    rng = random.Random(1)
    for _ in range(60):
        rows = random_rows(rng, rng.randrange(4))
        best = min(every_edit(rows, faults(rows), 2), key=lambda x: x[:2])
        got = solved(rows)
        assert "".join(e[2] * e[3] for e in got) == best[1], rows
        assert [(e[5], e[6]) for e in got if e[5] is not None] == best[2]
        assert least(rows)[:2] == best[:2]


@pytest.mark.parametrize("base", [1, 2, 7, 1024])
def test_divide_and_conquer_gives_the_least_audit(monkeypatch, base):
    monkeypatch.setattr(hirschberg, "BASE", base)
    rng = random.Random(base)
    for n in [0, 1, 2, 3, 5, 17, 40, 90] * 4:
        rows = random_rows(rng, n)
        cost, audit, out = least(rows)
        got = solved(rows)
        assert "".join(e[2] for e in got) == audit and [(e[5], e[6]) for e in got if e[5] is not None] == list(out)
        assert sum(R.COST[e[2]] + 3 * (e[1] == "truncated" and e[2] != "D") for e in got) == cost


def test_products_of_parts_cross_where_the_whole_does():
    rng = random.Random(9)
    for _ in range(40):
        text = "".join(rng.choice(list(R.STEPS)) for _ in range(60))
        cuts = sorted(rng.sample(range(61), 5))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
        states = hirschberg.crossings([hirschberg.product([R.STEPS[s] for s in p], 4) for p in parts], R.NOTHING, R.END)
        whole = hirschberg.crossings([R.STEPS[s] for s in text], R.NOTHING, R.END)
        assert states == [whole[c - 1] if c else R.NOTHING for c in [*cuts, 60]]


def expected(table):
    """The contract of the query, row by row."""
    convs = {}
    for conv, turn, role, text in table:
        convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(name.encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            convs[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
        marks = faults([r[1:] for r in rows])
        turns = [r[0] for r in rows if r[0] is not None]
        heads = [r[1][:1] for r in rows]
        cost, audit, fixed = least([r[1:] for r in rows])
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[marks.count(m) for m in ("blank", "duplicate", "truncated")],
                     sum(a + b not in {"su", "ua", "au"} for a, b in zip(heads, heads[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


def make_table():
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            if rng.random() < 0.95:
                role, text = random_rows(rng, 1)[0]
                rows.append((conv, None if rng.random() < 0.05 else turn + (turn > 4) * 3, rng.choice([role, None, role, role]), rng.choice([text, None, text, text])))
    for turn in range(700):  # a long conversation with rows said before, equal rows and nulls
        role, text = random_rows(rng, 1)[0]
        rows.append((1000, None if turn % 50 == 0 else turn, role, text))
    rows += [(1000, 5, "user", "Same.")] * 40 + [(1001, 1, "user", "Same.")] * 90 + [(1001, 2, "assistant", "É " * 20_000)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yo."), (None, None, None, None)]
    conv = next(i for i in range(2000, 9000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rng.shuffle(rows)
    return [*rows, (conv, 0, "user", "Dropped.")]


@pytest.mark.parametrize("long_rows, part_rows", [(4096, 65_536), (64, 100), (0, 7)])
def test_query_equals_the_contract_on_short_and_dealt_conversations(spark, tmp_path, monkeypatch, long_rows, part_rows):
    monkeypatch.setattr(R, "LONG_ROWS", long_rows)
    monkeypatch.setattr(R, "PART_ROWS", part_rows)
    table = make_table()
    df = spark.createDataFrame(table, SCHEMA).selectExpr("*", "'x' as times", "'x' as fault", "'x' as part", "1 as _c")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = R.op12_conversation_repair(spark, str(tmp_path)).collect()
    got = {r["conv_id"]: (*[r[c] for c in R.DIGESTS], r["audit"], r["repaired_sha256"]) for r in rows}
    want = expected(table)
    assert len(rows) == len(want) and {k: v for k, v in got.items() if v != want[k]} == {}


def test_edges(spark):
    assert R.summaries(R.repair(spark.createDataFrame([], SCHEMA))).count() == 0
    edits = R.repair(spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 1, "user", "Hi?")], SCHEMA)).collect()
    assert [(e["edit"], e["times"], e["role"], e["text"]) for e in edits] == [
        ("K", 1, "system", "Be kind."), ("K", 1, "user", "Hi?"), ("D", 1, None, None), ("I", 1, "assistant", "")]
