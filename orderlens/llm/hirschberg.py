"""Cheapest edits of a sequence of turns, by divide and conquer over four-state cost vectors.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles, so four states say what it
has come to: nothing, a system turn, a user turn (an answer is due), an answer (it may end).  A turn is
a 4 x 4 table of steps; a stretch of turns is one too, so the same code divides the rows of a block
and the blocks of a long conversation.

A path is named by its audit, the initials of its edits.  Inserts belong to the turn that follows, so
every audit of a stretch ends with the edit of a turn and none begins another one: paths compare by
their first halves alone, and a cost vector needs only the order of its four audits besides the costs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

STATES = range(4)
INF = 1 << 50
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3  # costs; the last is added when a truncated turn stays
DUE = "uuau"  # the initial of the role that each state asks for
AFTER = (2, 2, 3, 2)  # the state once that role is there
ROLES = "sua."  # a dot is any other role
SOUND, TRUNCATED, LOST = range(3)  # what is wrong with a turn; a lost one must go
LEGAL = {"su", "ua", "au"}

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # cost of each state, and the rank of its audit
Step = tuple[Vector, ...]  # a vector for each state that a stretch begins in
START: Vector = ((0, INF, INF, INF), (0, 0, 0, 0))


def _trailing(state: int) -> str:
    """Roles to insert at the end of a conversation."""
    roles = ""
    while state not in (0, 3):
        roles, state = roles + DUE[state], AFTER[state]
    return roles


TRAILING = tuple(map(_trailing, STATES))
END = tuple(INSERT * len(roles) for roles in TRAILING)


def code_of(role: str, fault: int) -> int:
    return ROLES.index(role if role in "sua" and role else ".") * 3 + fault


@cache
def edits(code: int) -> tuple[tuple[tuple[int, str, str, str] | None, ...], ...]:
    """(cost, audit, inserted roles, role or '' if deleted) of the best edit of a turn from each state to each."""
    role, fault = ROLES[code // 3], code % 3
    table = []
    for begin in STATES:
        best: list = [None] * 4
        state, inserted = begin, ""
        for _ in range(3):  # two inserts lead to every state there is
            options = [(state, DELETE, "D", "")]
            if fault != LOST:
                more = UNFINISHED * (fault == TRUNCATED)
                options.append((AFTER[state], REROLE + more, "R", DUE[state]))
                if role == DUE[state]:
                    options.append((AFTER[state], KEEP + more, "K", role))
                elif role == "s" and state == 0:
                    options.append((1, KEEP + more, "K", role))
            for end, cost, letter, kept in options:
                found = (cost + INSERT * len(inserted), "I" * len(inserted) + letter, inserted, kept)
                if best[end] is None or found < best[end]:
                    best[end] = found
            inserted, state = inserted + DUE[state], AFTER[state]
        table.append(tuple(best))
    return tuple(table)


@cache
def step_of(code: int) -> Step:
    """The step of a single turn."""
    vectors = []
    for row in edits(code):
        order = sorted(x[1] for x in row if x)
        vectors.append(
            (tuple(x[0] if x else INF for x in row), tuple(order.index(x[1]) if x else 0 for x in row))
        )
    return tuple(vectors)


@cache
def identity() -> Step:
    return tuple((tuple(0 if a == b else INF for b in STATES), (0, 0, 0, 0)) for a in STATES)


def forward(vector: Vector, step: Step) -> tuple[int, Vector]:
    """(cost taken out, the vector after one more step); the least cost of a vector is 0."""
    costs, ranks = vector
    found: list = []
    for end in STATES:
        options = [
            (costs[s] + step[s][0][end], ranks[s], step[s][1][end])
            for s in STATES
            if costs[s] < INF and step[s][0][end] < INF
        ]
        found.append(min(options, default=None))
    order = sorted(x[1:] for x in found if x)
    least = min((x[0] for x in found if x), default=0)
    return least, (
        tuple(x[0] - least if x else INF for x in found),
        tuple(order.index(x[1:]) if x else 0 for x in found),
    )


def backward(costs: tuple[int, ...], step: Step) -> tuple[int, ...]:
    """Cost to go one step earlier, up to a constant."""
    found = [min(step[s][0][end] + costs[end] for end in STATES) for s in STATES]
    least = min(found)
    return tuple(min(x - least, INF) if least < INF else INF for x in found)


@cache
def _forward_turn(vector: Vector, code: int) -> tuple[int, Vector]:
    return forward(vector, step_of(code))


@cache
def _backward_turn(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    return backward(costs, step_of(code))


def _tools(items: Sequence):
    """Functions for turns (codes, remembered by the worker) or for longer stretches (steps)."""
    if items and isinstance(items[0], int):
        return _forward_turn, _backward_turn, step_of
    return forward, backward, lambda step: step


def product(items: Sequence) -> Step:
    """One step for all items."""
    advance = _tools(items)[0]
    vectors = []
    for vector in identity():
        total = 0
        for item in items:
            cost, vector = advance(vector, item)
            total += cost
        vectors.append((tuple(c + total if c < INF else INF for c in vector[0]), vector[1]))
    return tuple(vectors)


def crossings(items: Sequence, begin: int, end: int | None) -> list[int]:
    """The state after each item on the cheapest path, the one of the least audit among equals.

    ``end`` is the state to end in; None is the end of the conversation.
    """
    advance, retreat, step = _tools(items)
    last = END if end is None else tuple(0 if s == end else INF for s in STATES)
    states = [0] * len(items)
    todo = [(0, len(items), begin, last)] if items else []
    while todo:
        low, high, start, costs = todo.pop()
        if high - low == 1:
            reach, ranks = step(items[low])[start]
            states[low] = min(STATES, key=lambda s: (reach[s] + costs[s], ranks[s]))
            continue
        middle = (low + high) // 2
        vector = (tuple(0 if s == start else INF for s in STATES), (0, 0, 0, 0))
        for i in range(low, middle):
            vector = advance(vector, items[i])[1]
        to_go = costs
        for i in range(high - 1, middle - 1, -1):
            to_go = retreat(to_go, items[i])
        crossing = min(STATES, key=lambda s: (vector[0][s] + to_go[s], vector[1][s]))
        todo.append((middle, high, crossing, costs))
        todo.append((low, middle, start, tuple(0 if s == crossing else INF for s in STATES)))
    return states
