"""Suffix arrays by linear grouping construction.

Suffixes are grouped by their Lyndon prefix: groups start as those of one first symbol, and are
taken from the highest down. A suffix of the group at hand points to the last one before it in
a lower group; there the group at hand continues the prefix, so those pointed at move up to a
new group right after their own, more pointers higher. With all groups known, going through the
suffixes in ascending order puts each suffix before it, and along its pointers, at the next free
place of its group. No ranks are renamed and nothing is solved recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of the suffixes of text in ascending order; a prefix comes first."""
    n = len(text)
    if n < 2:
        return list(range(n))
    group, previous = _grouped(text)
    return _emitted(n, group, previous)


def _grouped(text: Sequence[int]) -> tuple[list[int], list[int]]:
    """For each suffix where its final group starts in the order, and whom it points to (or -1)."""
    n = len(text)
    # `order` holds the groups one after another; `size` is by the first place of a group.
    order = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    start = 0
    for at, suffix in enumerate(order):
        if text[suffix] != text[order[start]]:
            start = at
        place[suffix], group[suffix] = at, start
        size[start] += 1

    previous = [-2] * n
    end = n
    while end > 0:
        first = group[order[end - 1]]
        members = sorted(order[first:end])
        pointed: dict[int, int] = {}
        for suffix in members:
            p = suffix - 1
            while p >= 0 and group[p] >= first:
                p = previous[p]
            previous[suffix] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for p, k in pointed.items():
                by_count.setdefault(k, []).append(p)
            for k in sorted(by_count, reverse=True):
                moved: dict[int, int] = {}
                for p in by_count[k]:  # to the end of its group, which gets shorter
                    g = group[p]
                    size[g] -= 1
                    last = g + size[g]
                    other, at = order[last], place[p]
                    order[at], place[other] = other, at
                    order[last], place[p] = p, last
                    moved[g] = moved.get(g, 0) + 1
                for g, count in moved.items():
                    new = g + size[g]
                    size[new] = count
                    for at in range(new, new + count):
                        group[order[at]] = new
        end = first
    return group, previous


def _emitted(n: int, group: list[int], previous: list[int]) -> list[int]:
    result, placed = [-1] * n, [False] * n
    free = list(range(n))  # by the first place of a group: where its next suffix goes

    def put(suffix: int) -> None:
        while suffix >= 0 and not placed[suffix]:
            g = group[suffix]
            result[free[g]] = suffix
            free[g] += 1
            placed[suffix] = True
            suffix = previous[suffix]

    put(n - 1)  # as from the empty suffix, which comes before all
    for at in range(n):
        put(result[at] - 1)
    return result
