"""Cheapest, then least, path through a chain of small min-plus matrices, in linear space.

A step's matrix holds for every pair of states (p, q) the cost of the best way
from p to q in this step and a key that orders the ways out of p, or None. Forward
vectors carry each state's cost and the rank of its least way among the states';
backward vectors carry costs. They meet in the middle of a stretch: among the
states where both add up to the least cost, the one of least rank is the crossing;
then both halves are solved. Ways of equally many steps are never prefixes of one
another, so ranks decide the order of whole ways.
"""

from __future__ import annotations

from collections.abc import Sequence

FAR = 1 << 60
BASE = 1024  # steps whose backward vectors are kept at once


def backward(steps: Sequence, lo: int, hi: int, end: Sequence[int], keep: list | None = None) -> list[int]:
    """Costs from every state before step ``lo`` through step ``hi - 1`` to ``end``."""
    cost = list(end)
    for i in range(hi - 1, lo - 1, -1):
        if keep is not None:
            keep.append(cost)
        cost = [min([w[0] + c for w, c in zip(row, cost) if w], default=FAR) for row in steps[i]]
    return cost


def forward(steps: Sequence, lo: int, hi: int, cost: list, rank: list) -> tuple[list, list]:
    """Costs and ranks of the states after the steps, from those before them."""
    n = len(cost)
    for i in range(lo, hi):
        best: list = [None] * n
        for p, row in enumerate(steps[i]):
            if cost[p] < FAR:
                for q, w in enumerate(row):
                    if w:
                        way = (cost[p] + w[0], rank[p], w[1])
                        if best[q] is None or way < best[q]:
                            best[q] = way
        cost = [b[0] if b else FAR for b in best]
        order = sorted(b[1:] for b in best if b)
        rank = [order.index(b[1:]) if b else n for b in best]
    return cost, rank


def crossings(steps: Sequence, start: int, end: Sequence[int]) -> list[int]:
    """The state after every step of the best way from ``start`` to costs ``end``."""
    out: list[int] = []
    todo = [(0, len(steps), None)]  # None: the end of all steps; else the state that the stretch has to reach
    state = start
    while todo:
        lo, hi, aim = todo.pop()
        term = end if aim is None else [0 if q == aim else FAR for q in range(len(end))]
        if hi - lo <= BASE:
            kept: list = []
            backward(steps, lo, hi, term, kept)
            for i in range(lo, hi):
                after = kept.pop()
                state = min((w[0] + after[q], w[1], q) for q, w in enumerate(steps[i][state]) if w)[2]
                out.append(state)
            continue
        mid = (lo + hi) // 2
        one = [0 if q == state else FAR for q in range(len(end))]
        cost, rank = forward(steps, lo, mid, one, [0] * len(end))
        rest = backward(steps, mid, hi, term)
        cross = min((c + r, k, q) for q, (c, r, k) in enumerate(zip(cost, rest, rank)))[2]
        todo += [(mid, hi, aim), (lo, mid, cross)]
    return out


def product(steps: Sequence, states: int) -> list:
    """One matrix for the whole chain; keys are ranks among the ways out of a state."""
    out = []
    for p in range(states):
        cost, rank = forward(steps, 0, len(steps), [0 if q == p else FAR for q in range(states)], [0] * states)
        out.append([(c, k) if c < FAR else None for c, k in zip(cost, rank)])
    return out
