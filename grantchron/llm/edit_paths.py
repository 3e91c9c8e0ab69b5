"""Cheapest ways of turning roles into `(s?(ua)+)?`, by cost vectors that meet in the middle.

Four states say what the roles given out so far end in. A vector holds, for each state, the cost
of reaching it (or of ending from it) and the rank of its audit among those of the other states.
Rows add to an audit some `I` and one other letter, so no audit of as many rows is the beginning
of another, and ranks and letters alone order them; audits themselves are never kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_GIVEN = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5

#: For each state the ways on: (next state, cost, letters or rank of the audit).
Step = tuple[tuple[tuple[int, int, str | int], ...], ...]
#: For each state, or each of several starts and state, (cost, rank), or None where there is no way.
Vector = tuple[tuple[int, int] | None, ...]

INSERTED = {SYSTEM: USER, NOTHING: USER, USER: ASSISTANT, ASSISTANT: USER}


def _inserts(state: int) -> list[tuple[int, int]]:
    """(inserted rows, state after them); a third one never comes cheaper."""
    once = INSERTED[state]
    return [(0, state), (1, once), (2, INSERTED[once])]


@lru_cache(None)
def row_step(initial: str, unfit: bool, cut_short: bool) -> Step:
    """What may become of one row, with the rows inserted before it; unfit ones are deleted."""
    extra = CUT_SHORT if cut_short else 0
    step = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        for n, at in _inserts(state):
            ways = [(at, DELETE, "D")]
            if not unfit:
                if at in _GIVEN.get(initial, {}):
                    ways.append((_GIVEN[initial][at], extra, "K"))
                ways += [(_GIVEN[r][at], REROLE + extra, "R") for r in "ua" if at in _GIVEN[r]]
            for to, cost, letter in ways:
                way = (cost + n * INSERT, "I" * n + letter)
                best[to] = min(best.get(to, way), way)
        step.append(tuple((to, *way) for to, way in sorted(best.items())))
    return tuple(step)


#: After the last row: what has to be inserted to end well. Leads to state NOTHING.
END: Step = (
    ((NOTHING, 0, ""),),
    ((NOTHING, 2 * INSERT, "II"),),
    ((NOTHING, INSERT, "I"),),
    ((NOTHING, 0, ""),),
)


def only(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


#: From each state, in one vector.
EACH: Vector = tuple((0, 0) if start == s else None for start in range(4) for s in range(4))


def _ranked(found: list[tuple | None]) -> Vector:
    """(cost, how the audits compare) as costs above the least one and ranks."""
    there = [f for f in found if f is not None]
    least = min(f[0] for f in there)
    rank = {k: i for i, k in enumerate(sorted({f[1] for f in there}))}
    return tuple(None if f is None else (f[0] - least, rank[f[1]]) for f in found)


@lru_cache(1 << 14)
def ahead(before: Vector, step: Step) -> Vector:
    """The vector after a step."""
    found: list[tuple | None] = [None] * len(before)
    for i, at in enumerate(before):
        if at is not None:
            for to, cost, letters in step[i % 4]:
                way = (at[0] + cost, (at[1], letters))
                place = i - i % 4 + to
                if found[place] is None or way < found[place]:
                    found[place] = way
    return _ranked(found)


@lru_cache(1 << 14)
def back(step: Step, after: Vector) -> Vector:
    """The vector before a step, of what is still to come."""
    found: list[tuple | None] = [None] * 4
    for state in range(4):
        ways = [
            (cost + after[to][0], (letters, after[to][1]))
            for to, cost, letters in step[state]
            if after[to] is not None
        ]
        found[state] = min(ways, default=None)
    return _ranked(found)


def path(steps: Sequence[Step], start: int, end: int) -> list[tuple[int, int, str | int]]:
    """For each step the way (next state, cost, letters) of the cheapest, and of these least, audit.

    Costs from the start and from the end meet mid-way, in a state that some best path crosses;
    either half is then solved on its own. Space is linear in the number of steps.
    """
    found: list[tuple[int, int, str | int]] = []

    def between(low: int, high: int, start: int, end: int) -> None:
        if high - low == 1:
            found.append(min((w for w in steps[low][start] if w[0] == end), key=lambda w: w[1:]))
            return
        middle = (low + high) // 2
        left, right = only(start), only(end)
        for i in range(low, middle):
            left = ahead(left, steps[i])
        for i in range(high - 1, middle - 1, -1):
            right = back(steps[i], right)
        crossing = min(
            (a[0] + b[0], a[1], b[1], state)
            for state, (a, b) in enumerate(zip(left, right, strict=True))
            if a is not None and b is not None
        )[-1]
        between(low, middle, start, crossing)
        between(middle, high, crossing, end)

    if steps:
        between(0, len(steps), start, end)
    return found


def as_step(steps: Sequence[Step]) -> Step:
    """Many steps as one: costs from each state to each, and ranks of the audits."""
    vector = EACH
    for step in steps:
        vector = ahead(vector, step)
    return tuple(
        tuple((to, *vector[start * 4 + to]) for to in range(4) if vector[start * 4 + to] is not None)
        for start in range(4)
    )
