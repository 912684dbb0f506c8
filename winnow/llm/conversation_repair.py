"""Conversation structure repair (operator 12).

A conversation is repaired by the cheapest edits (keep, rerole, delete, insert)
after which its roles read ``(s?(ua)+)?``; of equally cheap ones, those whose
initials in order are least in ASCII. Reading a repaired prefix is an automaton of
four states (nothing yet, system, user, assistant), and every row is a step whose
matrix holds, for each pair of states, the cheapest edits between them: some
inserts, then the row's own edit. The path is found by Hirschberg's divide and
conquer (``hirschberg``): forward and backward vectors of four costs meet in the
middle, the least cheapest crossing is chosen, both halves are solved, so memory is
linear in the rows. From one state different edits lead to different audits of
which none starts another, so the choice is unique. Rows that must go (blank or
said before) are no steps: their D comes right after the row before, for D sorts
before I and leaves the state as it is.

Conversations of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` of text go to one task
each, sorted, in one shuffle. Longer ones (one may hold a third of all rows) are
dealt by ranges of their order into parts of about ``PART_ROWS`` rows: equal rows
are counted first, rows said before are marked by a join on digests, every part
gives the product of its matrices, crossings between parts are chosen over these
products, and then each part is solved between its two crossings in parallel. Both
ways give the same rows. Only the digests of ``summaries`` read a long conversation
in one task, as a stream: a SHA-256 has no other order. Its audit is one string.

``repair`` returns edits in order: ``edit`` (K, R, D, I), ``times`` (equal edits of
equal rows counted together), ``fault`` (blank, duplicate, truncated or null),
``was`` (the row's role) and the new ``role`` and ``text`` (null when deleted).

Order and edge cases: rows go by turn (nulls first), then role, the text's first 64
characters and its SHA-256. A null conv_id is one conversation of its own; a null
role or text is one blank; an empty role has no initial, so keeping such a row
leaves the roles' string as it is. Rows with equal turns follow each other; very
long texts are passed through whole; ``times`` 0 names a conversation only, which
then has one row with a null edit; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, shuffle_parts, ship_package, stage, table
from .hirschberg import crossings, product

LONG_ROWS, LONG_BYTES = 4096, 16 << 20  # a conversation beyond either is dealt to several tasks
PART_ROWS = 65_536  # rows of a part of a long conversation
OUT_ROWS, OUT_CHARS = 4096, 4 << 20  # rows and text of a written batch

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs of the edits and of a truncated row that stays
NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
OTHER = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what an inserted or reroled row leads to
NAME = {USER: "user", ASSISTANT: "assistant"}
CLOSING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}  # inserts that end the roles well
END = [INSERT * len(CLOSING[p]) for p in range(4)]
SPACE = " \t\n\x0b\x0c\r"


def _step(initial: str, truncated: bool) -> list:
    """The matrix of a row: cheapest (cost, edits) between two states."""
    out: list = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state, word = start, ""
        for _ in range(3):
            more = TRUNCATED * truncated
            ways = [("D", DELETE, state), ("R", RETYPE + more, OTHER[state])]
            kept = state if initial == "" else NEXT.get(initial, {}).get(state)
            if kept is not None:
                ways.append(("K", more, kept))
            for letter, cost, q in ways:
                way = (INSERT * len(word) + cost, word + letter)
                if out[start][q] is None or way < out[start][q]:
                    out[start][q] = way
            state, word = OTHER[state], word + "I"
    return out


# A symbol is one character: the kind of initial and whether the row is truncated.
_KINDS = ["s", "u", "a", "", None]
STEPS = {chr(65 + 2 * i + t): _step("?" if k is None else k, bool(t)) for i, k in enumerate(_KINDS) for t in (0, 1)}


def symbol(role: str, fault: str | None) -> str:
    kind = role[:1]
    return chr(65 + 2 * (_KINDS.index(kind) if kind in _KINDS else 4) + (fault == "truncated"))


def words(symbols: str, start: int, end: list) -> tuple[list[str], int]:
    """The edits of every row from state ``start`` on, and the last state."""
    steps = [STEPS[s] for s in symbols]
    out, p = [], start
    for step, q in zip(steps, crossings(steps, start, end)):
        out.append(step[p][q][1])
        p = q
    return out, p


@lru_cache(maxsize=1 << 14)
def _short(symbols: str) -> tuple[list[str], int]:
    return words(symbols, NOTHING, END)


def _whole(symbols: str) -> tuple[list[str], int]:
    return _short(symbols) if len(symbols) <= 32 else words(symbols, NOTHING, END)


def fault_of(text: str, seen: bool) -> str | None:
    body = text.rstrip(SPACE)
    if not body:
        return "blank"
    if seen:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


# ---------------------------------------------------------------------------
# Rows of one conversation or part
# ---------------------------------------------------------------------------

FIELDS = ["conv_id", "part", "seq", "turn", "fault", "edit", "times", "was", "role", "text"]


def _schema(conv: str, turn: str) -> str:
    return f"conv_id {conv}, part int, seq long, turn {turn}, fault string, edit string, times long, was string, role string, text string"


def _edits(rows: Iterator, ways: list[str], state: int) -> Iterator[tuple]:
    """Edits (turn, fault, edit, times, was, role, text) of rows (turn, role,
    text, fault, times); ``ways`` are those of the rows that may stay."""
    at = 0
    for turn, role, text, fault, times in rows:
        if fault in ("blank", "duplicate"):
            yield turn, fault, "D", times, role, None, None
            continue
        for letter in ways[at]:
            if letter == "I":
                state = OTHER[state]
                yield None, None, "I", 1, None, NAME[state], ""
            elif letter == "R":
                state = OTHER[state]
                yield turn, fault, "R", 1, role, NAME[state], text
            elif letter == "D":
                yield turn, fault, "D", 1, role, None, None
            else:
                state = state if role == "" else NEXT[role[0]][state]
                yield turn, fault, "K", 1, role, role, text
        at += 1
        if times > 1:
            yield turn, "duplicate", "D", times - 1, role, None, None


def _closing(state: int) -> Iterator[tuple]:
    for _ in CLOSING[state]:
        state = OTHER[state]
        yield None, None, "I", 1, None, NAME[state], ""


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1] or "")
        if len(held) >= OUT_ROWS or chars >= OUT_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, OUT_ROWS):
            yield from zip(*[c.to_pylist() for c in batch.slice(i, OUT_ROWS).columns])


def _solve(schema: pa.Schema):
    """Sorted rows (conv_id, turn, role, text, times) of whole conversations to edits."""

    def conversation(rows: Iterator) -> Iterator[tuple]:
        seen, said = set(), []
        for _, turn, role, text, times in rows:
            if times:
                said.append((turn, role, text, fault_of(text, (role, text) in seen), times))
                seen.add((role, text))
        ways, state = _whole("".join(symbol(r[1], r[3]) for r in said if r[3] not in ("blank", "duplicate")))
        yield from _edits(iter(said), ways, NOTHING)
        yield from _closing(state)

    def run(batches):
        def out():
            for conv, rows in groupby(_rows(batches), itemgetter(0)):
                seq = -1
                for seq, e in enumerate(conversation(rows)):
                    yield conv, 0, seq, *e
                if seq < 0:
                    yield conv, 0, 0, None, None, None, 0, None, None, None

        return _batches(out(), schema)

    return run


# ---------------------------------------------------------------------------
# Long conversations: parts of a range each
# ---------------------------------------------------------------------------

def _parts(schema: pa.Schema):
    """Sorted rows (conv_id, turn, role, text, times, seen) of a range to the same rows
    numbered, and after those of a conversation one with its symbols."""

    def run(batches):
        part = TaskContext.get().partitionId()

        def out():
            for conv, rows in groupby(_rows(batches), itemgetter(0)):
                symbols = []
                for seq, (_, turn, role, text, times, seen) in enumerate(rows):
                    fault = fault_of(text, seen)
                    if fault not in ("blank", "duplicate"):
                        symbols.append(symbol(role, fault))
                    yield conv, part, seq, turn, fault, None, times, role, None, text
                yield conv, part, -1, None, None, None, 0, None, "".join(symbols), None

        return _batches(out(), schema)

    return run


def _cross(schema: pa.Schema):
    """Products (conv_id, part, symbols, matrix) in order to the states at each
    part's start and end."""

    def run(batches):
        def out():
            for conv, rows in groupby(_rows(batches), itemgetter(0)):
                parts, steps = [], []
                for _, part, flat in rows:
                    parts.append(part)
                    pairs = [(c, k) if c >= 0 else None for c, k in zip(flat[::2], flat[1::2])]
                    steps.append([pairs[i : i + 4] for i in range(0, 16, 4)])
                p = NOTHING
                for part, q in zip(parts, crossings(steps, NOTHING, END)):
                    yield conv, part, p, q, part == parts[-1]
                    p = q

        return _batches(((*r, None) for r in out()), schema)

    return run


def _matrices(schema: pa.Schema):
    def run(batches):
        def out():
            for conv, part, symbols in _rows(batches):
                m = product([STEPS[s] for s in symbols], 4)
                yield conv, part, [x for row in m for w in row for x in (w or (-1, -1))], None

        return _batches(out(), schema)

    return run


def _between(schema: pa.Schema):
    """Each part's rows (its symbols and states first) to edits."""

    def run(batches):
        def out():
            for (conv, part), rows in groupby(_rows(batches), itemgetter(0, 1)):
                _, _, _, _, _, _, _, _, symbols, _, p, q, last = next(rows)
                ways, state = words(symbols, p, [0 if s == q else 1 << 60 for s in range(4)])
                said = ((turn, was, text, fault, times) for _, _, _, turn, fault, _, times, was, _, text, *_ in rows)
                seq = -1
                for seq, e in enumerate(_edits(said, ways, p)):
                    yield conv, part, seq, *e
                if last:
                    for seq, e in enumerate(_closing(state), seq + 1):
                        yield conv, part, seq, *e

        return _batches(out(), schema)

    return run


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _ordered(rows: DataFrame) -> list:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64), F.sha2("text", 256)]


def _long(rows: DataFrame, ddl: str, conv: str) -> DataFrame:
    spark = rows.sparkSession
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times")).filter("times > 0")
    equal = stage(equal.withColumn("said", F.sha2(F.concat_ws("\0", "role", "text"), 256)), "repair-equal")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = equal.groupBy(F.col("conv_id").alias("_c"), F.col("said").alias("_s")).agg(F.min(when).alias("first"))
    rows = equal.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("said") == F.col("_s"))).select(
        "conv_id", "turn", "role", "text", "times", (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("seen"))
    n = max(shuffle_parts(spark), -(-equal.count() // PART_ROWS))
    keys = _ordered(rows)
    arrow = _arrow(spark, ddl)
    parts = stage(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).mapInArrow(_parts(arrow), ddl), "repair-parts")
    heads = parts.filter("seq = -1")
    of_part = f"conv_id {conv}, part int, flat array<long>, _ string"
    flat = heads.select("conv_id", "part", "role").mapInArrow(_matrices(_arrow(spark, of_part)), of_part)
    states = f"conv_id {conv}, part int, p int, q int, last boolean, _ string"
    states = (flat.select("conv_id", "part", "flat").repartition("conv_id").sortWithinPartitions("conv_id", "part")
              .mapInArrow(_cross(_arrow(spark, states)), states).select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), "p", "q", "last"))
    known = heads.join(stage(states, "repair-states"), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")))
    none = [F.lit(None).cast("int").alias("p"), F.lit(None).cast("int").alias("q"), F.lit(None).cast("boolean").alias("last")]
    both = parts.filter("seq >= 0").select(*FIELDS, *none).unionAll(known.select(*FIELDS, "p", "q", "last"))
    return (both.repartition(n, "conv_id", "part").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_between(arrow), ddl)
            .repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq"))


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           times: str | None = None) -> DataFrame:
    """The edits of every conversation (see above). The rows of a conversation are
    in one partition, in order of (part, seq)."""
    spark = rows.sparkSession
    ship_package(spark)
    blank = F.lit(" ")
    rows = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), blank).alias("role"),
                       F.coalesce(F.col(text), blank).alias("text"), (F.col(times) if times else F.lit(1)).cast("long").alias("times"))
    conv, kind = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    ddl = _schema(conv, kind)
    size = rows.groupBy("conv_id").agg(F.sum("times").alias("n"), F.sum(F.octet_length("text")).alias("b"))
    long = stage(size.filter((F.col("n") > LONG_ROWS) | (F.col("b") > LONG_BYTES)).select(F.col("conv_id").alias("_c")), "repair-long")
    many = long.count()
    short = rows
    if many:
        here = F.col("conv_id").eqNullSafe(F.col("_c"))
        short = rows.join(maybe_broadcast(long, many, 64), here, "left_anti")
    out = short.repartition("conv_id").sortWithinPartitions(*_ordered(short)).mapInArrow(_solve(_arrow(spark, ddl)), ddl)
    return out.unionAll(_long(rows.join(maybe_broadcast(long, many, 64), here, "left_semi"), ddl, conv)) if many else out


# ---------------------------------------------------------------------------
# The query: damage, repair, digests
# ---------------------------------------------------------------------------

DIGESTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
LEGAL = {"su", "ua", "au"}
COST = {"K": 0, "R": RETYPE, "D": DELETE, "I": INSERT, None: 0}


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the planted faults; ``times`` 0 for a dropped row, 2 for a repeated one."""
    text = F.coalesce("text", F.lit(" "))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name) % 20
    return conversations.select("conv_id", "turn", "role", "text", fault.alias("fault")).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("times"))


def _digest(schema: pa.Schema):
    def run(batches):
        def out():
            for conv, rows in groupby(_rows(batches), itemgetter(0)):
                count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
                low = high = last = None
                turns = illegal = cost = 0
                audit, digest, told, before = [], hashlib.sha256(), False, None
                for _, turn, fault, edit, times, was, role, text in rows:
                    cost += COST[edit] * times + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                    if fault:
                        count[fault] += times
                    if edit:
                        audit.append(edit * times)
                    if was is not None:
                        now = was[:1]
                        illegal += (before is not None and before + now not in LEGAL) + times - 1
                        before = now
                        if turn is not None:
                            low, high = turn if low is None else low, turn
                            turns += turn != last
                            last = turn
                    if role is not None:
                        digest.update(("\n" if told else "").encode() + f"{role}:{text}".encode())
                        told = True
                gaps = 0 if low is None else high - low + 1 - turns
                yield conv, gaps, *count.values(), illegal, cost, digest.hexdigest(), "".join(audit)

        return _batches(out(), schema)

    return run


def summaries(edits: DataFrame) -> DataFrame:
    """One row a conversation from ``repair``'s rows as they stand: gaps, faults,
    illegal neighbours, cost, audit and the digest of the repaired rows."""
    conv = edits.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {conv}, {', '.join(f'{c} long' for c in DIGESTS)}, repaired_sha256 string, audit string"
    rows = edits.select("conv_id", "turn", "fault", "edit", "times", "was", "role", "text")
    return rows.mapInArrow(_digest(_arrow(edits.sparkSession, ddl)), ddl)


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return summaries(repair(damaged(table(spark, sf_dir, "conversations")), times="times"))
