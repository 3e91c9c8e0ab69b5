"""Plain versions of what the operators compute, one document at a time."""

import re
from collections import Counter, defaultdict

LAST = 2**63 - 1  # where a null id comes


def by_id(rows):
    """(id, text) of different rows in order of the id, null last."""
    return sorted({(LAST if r[0] is None else r[0], r[1] or "") for r in rows})


def repeated(items, width):
    """For each list of (key, sequence), in order: which entries lie in a window seen before."""
    seen, result = set(), {}
    for key, sequence in items:
        gone = [False] * len(sequence)
        for s in range(len(sequence) - width + 1):
            window = sequence[s : s + width]
            window = tuple(window) if isinstance(window, list) else window
            if window in seen:
                gone[s : s + width] = [True] * width
            seen.add(window)
        result[key] = gone
    return result


def ngrams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def groups(nodes, linked):
    """The least node that links reach, for each node."""
    result = {}
    for node in sorted(nodes):
        todo = [node] if node not in result else []
        while todo:
            x = todo.pop()
            if x not in result:
                result[x] = node
                todo += linked[x]
    return result


def jaccard_links(rows, n, threshold):
    """For each row number the numbers of rows it is linked with."""
    sets = [ngrams(r[1], n) if r[0] is not None else set() for r in rows]
    linked = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) / len(a | b) >= threshold:
                linked[i].add(j)
                linked[j].add(i)
    return linked


def highest_quotients(shares, seats, most):
    """Sainte-Laguë, one seat after another."""
    given = [0] * len(shares)
    for _ in range(seats):
        able = [i for i, g in enumerate(given) if g < most[i] and shares[i] > 0]
        if not able:
            break
        given[max(able, key=lambda i: (shares[i] / (2 * given[i] + 1), -i))] += 1
    return given


def multiset(rows):
    return Counter(map(repr, rows))
