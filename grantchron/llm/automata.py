"""Probabilistic automata learned from strings by merging compatible prefix-tree states."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass, field

ALPHA = 0.05  # of the test that two states differ
SYMBOLS = 66  # that a string may use; unseen ones share a small probability
UNSEEN = 0.02


@dataclass
class State:
    """How many strings pass, how many end here, and where each symbol leads how often."""

    count: int = 0
    ends: int = 0
    next: dict[str, int] = field(default_factory=dict)
    uses: dict[str, int] = field(default_factory=dict)


def prefix_tree(strings: Iterable[str]) -> list[State]:
    states = [State()]
    for string in strings:
        at = 0
        states[0].count += 1
        for symbol in string:
            state = states[at]
            if symbol not in state.next:
                state.next[symbol] = len(states)
                states.append(State())
            state.uses[symbol] = state.uses.get(symbol, 0) + 1
            at = state.next[symbol]
            states[at].count += 1
        states[at].ends += 1
    return states


def _differ(k1: int, n1: int, k2: int, n2: int, alpha: float) -> bool:
    """Hoeffding's bound on two observed shares."""
    if not n1 or not n2:
        return False
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(k1 / n1 - k2 / n2) > bound


def _compatible(states: list[State], a: int, b: int, alpha: float) -> bool:
    """Neither the states nor those that equal strings lead to from them differ."""
    todo = [(a, b)]
    while todo:
        x, y = (states[i] for i in todo.pop())
        if _differ(x.ends, x.count, y.ends, y.count, alpha):
            return False
        for symbol in x.uses.keys() | y.uses.keys():
            if _differ(x.uses.get(symbol, 0), x.count, y.uses.get(symbol, 0), y.count, alpha):
                return False
            if symbol in x.next and symbol in y.next:
                todo.append((x.next[symbol], y.next[symbol]))
    return True


def _fold(states: list[State], into: int, tree: int) -> None:
    """Add the tree at a state to another state and what follows it."""
    todo = [(into, tree)]
    while todo:
        into, tree = todo.pop()
        x, y = states[into], states[tree]
        x.count += y.count
        x.ends += y.ends
        for symbol, child in y.next.items():
            x.uses[symbol] = x.uses.get(symbol, 0) + y.uses[symbol]
            if symbol in x.next:
                todo.append((x.next[symbol], child))
            else:
                x.next[symbol] = child


def learn(strings: Iterable[str], alpha: float = ALPHA) -> list[State]:
    """States of an automaton; the first is where strings start. No strings give one empty state.

    States are taken in order of their distance from the start. Each is merged into the first
    final state that it is compatible with, or becomes final itself.
    """
    states = prefix_tree(strings)
    final = [0]
    frontier = deque((0, symbol) for symbol in sorted(states[0].next))
    known = {0}
    while frontier:
        parent, symbol = frontier.popleft()
        child = states[parent].next[symbol]
        if child in known:
            continue
        for other in final:
            if _compatible(states, other, child, alpha):
                states[parent].next[symbol] = other
                _fold(states, other, child)
                # What the fold hung below final states is still to be looked at.
                frontier.extend(
                    (f, s) for f in final for s in sorted(states[f].next) if states[f].next[s] not in known
                )
                break
        else:
            known.add(child)
            final.append(child)
            frontier.extend((child, s) for s in sorted(states[child].next))
    number = {s: i for i, s in enumerate(final)}
    return [
        State(
            states[s].count,
            states[s].ends,
            {c: number[t] for c, t in states[s].next.items()},
            dict(states[s].uses),
        )
        for s in final
    ]


def log_likelihood(states: list[State], string: str) -> float:
    """Mean log probability of the symbols and the end; unknown ways are evenly improbable."""
    rare, at, total = math.log(UNSEEN / SYMBOLS), 0, 0.0
    for symbol in string:
        if at >= 0 and symbol in states[at].next:
            state = states[at]
            total += math.log((1 - UNSEEN) * state.uses[symbol] / state.count + UNSEEN / SYMBOLS)
            at = state.next[symbol]
        else:
            total += rare
            at = -1
    end = states[at].ends / states[at].count if at >= 0 and states[at].count else 0.0
    return (total + math.log((1 - UNSEEN) * end + UNSEEN)) / (len(string) + 1)
