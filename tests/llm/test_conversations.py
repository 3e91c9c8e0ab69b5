"""Conversation repair against all ways of editing, whole and cut into segments."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from grantchron.llm import conversation_repair as repair, edit_paths
from grantchron.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place int, rows string, id string, cost long"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, (turn is not None, turn), role, text


def legal(roles):
    roles = roles[1:] if roles[:1] == ["s"] else roles
    return not roles or (len(roles) % 2 == 0 and all(r == "ua"[i % 2] for i, r in enumerate(roles)))


def is_legal(initials):
    return initials == "" or (initials != "s" and legal(list(initials)))


def cheapest(rows):
    """rows: (initial, unfit, cut_short). The least (cost, audit) of every way of editing."""
    best = (10**9, "")
    options = [[("D", "", 2)] if unfit else
               [("D", "", 2), ("K", i or "-", 5 * cut), ("R", "u", 1 + 5 * cut), ("R", "a", 1 + 5 * cut)]
               for i, unfit, cut in rows]
    for ways in itertools.product(*options):
        cost = sum(w[2] for w in ways)
        for n in itertools.product(range(3), repeat=len(rows) + 1):
            total = cost + 5 * sum(n)
            if total > best[0]:
                continue
            audit = "".join("I" * k + w[0] for k, w in zip(n, ways)) + "I" * n[-1]
            gaps = ["".join("?" * k) for k in n]
            pattern = "".join(g + w[1] for g, w in zip(gaps, ways)) + gaps[-1]
            holes = pattern.count("?")
            for fill in itertools.product("ua", repeat=holes):
                it = iter(fill)
                if is_legal("".join(next(it) if c == "?" else c for c in pattern)):
                    best = min(best, (total, audit))
                    break
    return best


def by_table(steps):
    """The same by keeping for each state its best (cost, audit) as they are."""
    at = {0: (0, "")}
    for step in steps:
        found = {}
        for state, (cost, audit) in at.items():
            for to, more, letters in step[state]:
                way = (cost + more, audit + letters)
                found[to] = min(found.get(to, way), way)
        at = found
    return at[0]


def test_paths_against_every_way_of_editing():
    rng = random.Random(3)
    kinds = [(i, u, c) for i in ("s", "u", "a", "x", "") for u, c in ((False, False), (True, False), (False, True))]
    for n in (0, 1, 2, 2, 3, 3, 3, 3):
        for _ in range(4):
            rows = [rng.choice(kinds) for _ in range(n)]
            ways = edit_paths.path([*(edit_paths.row_step(*r) for r in rows), edit_paths.END], 0, 0)
            assert (sum(w[1] for w in ways), "".join(w[2] for w in ways)) == cheapest(rows), rows


def test_long_paths_and_segments():
    rng = random.Random(4)
    kinds = [(i, u, not u and c) for i in "suax" for u in (False, True) for c in (False, True)]
    for n in (5, 17, 64, 300):
        for _ in range(10):
            steps = [edit_paths.row_step(*rng.choice(kinds)) for _ in range(n)]
            expected = by_table([*steps, edit_paths.END])
            ways = edit_paths.path([*steps, edit_paths.END], 0, 0)
            assert (sum(w[1] for w in ways), "".join(w[2] for w in ways)) == expected
            cuts = [0, *sorted(rng.sample(range(1, n), 3)), n]
            parts = [steps[a:b] for a, b in itertools.pairwise(cuts)]
            crossed = edit_paths.path([*map(edit_paths.as_step, parts), edit_paths.END], 0, 0)
            states = [0, *(w[0] for w in crossed)]
            found = [edit_paths.path(p, a, b) for p, a, b in zip(parts, states, states[1:])]
            found.append(edit_paths.path([edit_paths.END], states[-2], 0))
            audit = "".join(w[2] for ways in found for w in ways)
            assert (sum(w[1] for ways in found for w in ways), audit) == expected


def expected(rows):
    """What the query is to return, a conversation at a time."""
    groups = defaultdict(list)
    for conv, *rest in damage(rows):
        groups[conv].append(tuple(rest))
    result = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(groups[conv])
        turns = [t[1] for t, _, _ in mine if t[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in mine:
            solid = text.strip(SPACE)
            faults.append(
                "blank" if not solid else "duplicate" if (role, text) in seen
                else None if solid[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        steps = [
            edit_paths.row_step(r[:1], f in ("blank", "duplicate"), f == "truncated")
            for (_, r, _), f in zip(mine, faults)
        ]
        cost, audit = by_table([*steps, edit_paths.END])
        made, left = [], iter(mine)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            role = row[1] if letter == "K" else "assistant" if made and made[-1][0] == "u" else "user"
            made.append(f"{role}:{'' if row is None else row[2]}")
        assert is_legal("".join(m[0] for m in made)) and not list(left)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(made).encode()).hexdigest()
        result[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return result


def conversations():
    rng = random.Random(7)
    say = ["yes.", "no!", "why?", "well", "", " \t", "same as ever.", "a\nb.", "ünd 日.", None, "x" * 5000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = f"{rng.random()}." if rng.random() < 0.5 else rng.choice(say)
            rows.append((conv * 3, turn, role, text))
    # One holds a third of all rows, with gaps, ties, rows without a turn, and repeated rows.
    for i in range(200):
        turn = None if i % 40 == 0 else i // 2 * (3 if i > 100 else 1)
        rows.append((50, turn, ("user", "assistant")[i % 2], rng.choice(say) if i % 3 else f"{i}!"))
    rows += [(50, 7, "user", "same as ever.")] * 30
    rows += [(None, t, "user", "no id.") for t in (1, None, 4)] + [(None, 2, "assistant", "no.")]
    rows += [(900, None, None, None)]
    return [(*r, 1, "r", "i", 2) for r in rows]


def test_every_conversation_survives_loss_of_all_its_rows():
    rows = [(i, 0, "user", "a.") for i in range(200)]
    assert any(v == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for v in expected(rows).values())


@pytest.mark.parametrize(("tasks", "piece_rows"), [(1, 1000), (5, 1000), (17, 7)])
def test_conversations_against_plain_repair(spark, tasks, piece_rows):
    rows = conversations()
    rows += [(2000 + i, 0, "user", "a.", 1, "r", "i", 2) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    settings = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        pieces = repair.repair(repair.damaged(frame), present_col="present", piece_rows=piece_rows)
        found = repair.digests(pieces).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == expected(rows)
    assert len(found) == len({r[0] for r in rows})


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.digests(repair.repair(none)).collect() == []


def test_query_against_plain_repair(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    found = QUERIES["op11_conversation_repair"](spark, sf).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == expected(rows)
