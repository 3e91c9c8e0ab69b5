"""Conversation structure repair (11): the cheapest edits that make roles alternate.

Rows are sorted by conversation and turn over all tasks (a range shuffle), so a conversation of
any size is a run of rows in one task or in neighbouring ones. A task repairs the conversations
that it has whole. The first and the last of each task may go on in another one: those are
written as they are, and then repaired in segments. A segment's costs from each of four states
to each, 16 numbers, are all that its conversation has to gather; the states in which the best
path crosses from segment to segment come from them, and each segment is then repaired alone.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from grantchron.llm import edit_paths
from grantchron.llm.edit_paths import END, NOTHING, Step
from grantchron.session import materialize

SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECE_ROWS = 1_000  # edits in a row of the result, at most
_LEGAL = {"su", "ua", "au"}
_ROWS = "array<struct<edit:string,turn:long,role:string,text:string>>"
_ROW_TYPE = pa.list_(
    pa.struct([("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
)


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str

    @property
    def digest(self) -> bytes:
        """Role and text as 32 bytes, by which segments tell each other what they have."""
        role = self.role.encode()
        return hashlib.sha256(b"%d:%b%b" % (len(role), role, self.text.encode())).digest()


def fault(row: Row, seen: set) -> str | None:
    """The first fault of a row, given those (role, text) before it."""
    solid = row.text.strip(SPACE)
    if not solid:
        return "blank"
    if (row.role, row.text) in seen:
        return "duplicate"
    return None if solid[-1] in ".!?" else "truncated"


def faults(rows: list[Row], known: frozenset[bytes] = frozenset()) -> list[str | None]:
    """For each row its fault; known: digests of what earlier segments have."""
    seen: set[tuple[str, str]] = set()
    found = []
    for row in rows:
        what = fault(row, seen)
        if what != "blank" and known and what != "duplicate" and row.digest in known:
            what = "duplicate"
        found.append(what)
        seen.add((row.role, row.text))
    return found


def steps_of(rows: list[Row], found: list[str | None]) -> list[Step]:
    return [
        edit_paths.row_step(row.role[:1], what in ("blank", "duplicate"), what == "truncated")
        for row, what in zip(rows, found, strict=True)
    ]


def illegal_between(roles: Iterable[str]) -> int:
    initials = [role[:1] for role in roles]
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))


def gaps_in(turns: list[int | None]) -> int:
    there = [t for t in turns if t is not None]
    return max(there) - min(there) + 1 - len(set(there)) if there else 0


def repaired(
    rows: list[Row], known: frozenset[bytes] = frozenset(), start: int = NOTHING, end: int | None = None
) -> tuple[list[tuple], dict[str, int]]:
    """(edit, turn, role, text) in order and the counts, of a conversation or of a segment of one.

    A segment ends in the state `end`; without one, the conversation ends here.
    """
    found = faults(rows, known)
    steps = steps_of(rows, found)
    ways = edit_paths.path(steps + [END] * (end is None), start, NOTHING if end is None else end)
    edits: list[tuple] = []
    state = start
    for i, (to, _, letters) in enumerate(ways):
        for letter in letters:
            if letter == "I":
                state = edit_paths.INSERTED[state]
                edits.append(("I", None, _ROLE[state], ""))
            elif letter == "R":
                edits.append(("R", rows[i].turn, _ROLE[to], rows[i].text))
            else:
                edits.append((letter, *rows[i]))
        state = to
    counts = {what: found.count(what) for what in ("blank", "duplicate", "truncated")}
    counts["gaps"] = gaps_in([r.turn for r in rows])
    counts["illegal"] = illegal_between(r.role for r in rows)
    counts["cost"] = sum(way[1] for way in ways)
    return edits, counts


_ROLE = {edit_paths.USER: "user", edit_paths.ASSISTANT: "assistant"}


class _Pieces:
    """Rows of the result: (id, part, place, done, single, rows, counts)."""

    def __init__(self, id_type: pa.DataType, piece_rows: int):
        self.names = ["id", "part", "place", "done", "single", "rows", *COUNTS]
        self.id_type, self.piece_rows = id_type, piece_rows
        self.clear()

    def clear(self) -> None:
        self.found: list[tuple] = []
        self.size = 0

    def add(self, key, part: int, entries: list[tuple], counts: dict[str, int] | None, single: bool) -> None:
        single = single and counts is not None and len(entries) <= self.piece_rows
        for low in range(0, max(len(entries), 1), self.piece_rows):
            some = [
                {"edit": e, "turn": t, "role": r, "text": x}
                for e, t, r, x in entries[low : low + self.piece_rows]
            ]
            of = [None if counts is None else counts[c] if low == 0 else 0 for c in COUNTS]
            self.found.append((key, part, (part << 32) + low, counts is not None, single, some, *of))
            self.size += 1 + len(some)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.found, strict=True)) or [()] * len(self.names)
        kinds = [self.id_type, pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), _ROW_TYPE]
        kinds += [pa.int64()] * len(COUNTS)
        made = pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=self.names
        )
        self.clear()
        return made


def _schema(kind: str) -> str:
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return f"id {kind}, part int, place long, done boolean, single boolean, rows {_ROWS}, {counts}"


def repair(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Rows (id_col, place, single, rows, gaps, blank, duplicate, truncated, illegal, cost).

    `rows` are the edits in order, {edit, turn, role, text}: K kept, R with another role, D
    deleted, I inserted. A conversation's edits come in pieces of at most piece_rows, in the order
    of `place`; `single` says that there is one piece. Its counts are sums over its pieces.

    A conversation's rows are taken by turn (nulls first), then by role, the first 64 characters
    and the hash of the text; rows alike in all these are alike. Null roles and texts count as one
    space, a null id is an id like others, and turns are whole numbers. Rows whose present_col is
    not true only name their conversation, which has counts of 0 and no edits if it has no others.
    Other columns are left out; an empty table gives no rows. The sorted rows are written to the
    folder of spark.checkpoint.dir once.
    """
    kind = conversations.schema[id_col].dataType.simpleString()
    space = F.lit(" ")
    present = F.coalesce(F.col(present_col), F.lit(False)) if present_col else F.lit(True)
    rows = conversations.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
        present.alias("present"),
    )
    # The row's place lets equal rows, too, be dealt over tasks.
    order = ["id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text")]
    order.append(F.monotonically_increasing_id())
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    keyed = rows.select("*", *[c.alias(f"by{i}") for i, c in enumerate(order)])
    keys = [f"by{i}" for i in range(len(order))]
    placed = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*rows.columns)
    schema = _schema(kind)

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        inner, begun, key, run = False, False, None, []
        for batch in batches:
            out = out or _Pieces(batch.schema.field(0).type, piece_rows)
            for one, turn, role, text, there in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or one != key:
                    if begun:
                        edits, counts = repaired(run) if inner else (_as_they_are(run), None)
                        out.add(key, part, edits, counts, inner)
                        inner = True
                        if out.size > 4 * piece_rows:
                            yield out.batch()
                    begun, key, run = True, one, []
                if there:
                    run.append(Row(turn, role, text))
        if begun:
            out.add(key, part, _as_they_are(run), None, False)
            yield out.batch()

    stored = materialize(placed.mapInArrow(by_task, schema), "conversations")
    edges = stored.filter("NOT done").select("id", "part", "place", "rows")
    result = stored.filter("done").unionByName(_by_segments(edges, kind, piece_rows))
    return result.select(F.col("id").alias(id_col), "place", "single", "rows", *COUNTS)


def _as_they_are(run: list[Row]) -> list[tuple]:
    return [(None, *row) for row in run]


def _run_of(table: pa.Table) -> list[Row]:
    pieces = sorted(zip(table["place"].to_pylist(), table["rows"].to_pylist(), strict=True), key=lambda p: p[0])
    return [Row(r["turn"], r["role"], r["text"]) for _, piece in pieces for r in piece]


def _known(notes: pa.Table) -> frozenset[bytes]:
    return frozenset(bytes.fromhex(d) for d in notes["digest"].to_pylist() if d is not None)


def _by_segments(edges: DataFrame, kind: str, piece_rows: int) -> DataFrame:
    """Conversations that a task has at its first or last row, which others may go on with."""
    role = F.col("r.role")
    digest = F.sha2(
        F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, F.col("r.text")).cast("binary"), 256
    )
    own = edges.select("id", "part", F.explode("rows").alias("r")).select("id", "part", digest.alias("digest"))
    # A row for each task that has such a row, whatever the number of rows.
    first = F.min("part").over(Window.partitionBy("id", "digest"))
    seen = own.distinct().withColumn("first", first).filter("part > first").drop("first")

    def summarise(key: tuple, left: pa.Table, notes: pa.Table) -> pa.Table:
        run = _run_of(left)
        turns = [r.turn for r in run if r.turn is not None]
        made = {
            "rows": len(run),
            "first": min(turns, default=None),
            "last": max(turns, default=None),
            "starts": run[0].role[:1] if run else "",
            "ends": run[-1].role[:1] if run else "",
            "step": edit_paths.as_step(steps_of(run, faults(run, _known(notes)))),
        }
        return pa.table(
            {
                "id": pa.array([key[0].as_py()], left.schema.field("id").type),
                "part": pa.array([key[1].as_py()], pa.int32()),
                "found": [json.dumps(made)],
            }
        )

    def link(parts: pd.DataFrame) -> pd.DataFrame:
        """One row for each task that the conversation is in."""
        parts = parts.sort_values("part", ignore_index=True)
        found = [json.loads(x) for x in parts.found]
        steps = [tuple(tuple(map(tuple, ways)) for ways in x["step"]) for x in found]
        ways = edit_paths.path([*steps, END], NOTHING, NOTHING)
        states = [NOTHING, *(way[0] for way in ways[:-1])]
        last_turn, last_role = None, None
        gaps, illegal = [], []
        for x in found:
            gap = odd = 0
            if x["first"] is not None:
                if last_turn is not None:
                    gap = max(x["first"] - last_turn - 1, 0)
                last_turn = x["last"]
            if x["rows"]:
                odd = int(last_role is not None and last_role + x["starts"] not in _LEGAL)
                last_role = x["ends"]
            gaps.append(gap)
            illegal.append(odd)
        ends = [None if i == len(found) - 1 else states[i + 1] for i in range(len(found))]
        return pd.DataFrame(
            {
                "id": parts.id,
                "part": parts.part,
                "start": states[: len(found)],
                "end": pd.array(ends, "Int64"),
                "gap": gaps,
                "odd": illegal,
                "alone": len(found) == 1,
            }
        )

    def finish(key: tuple, left: pa.Table, notes: pa.Table) -> pa.Table:
        plan = next(n for n in notes.to_pylist() if n["start"] is not None)
        edits, counts = repaired(_run_of(left), _known(notes), plan["start"], plan["end"])
        counts["gaps"] += plan["gap"]
        counts["illegal"] += plan["odd"]
        out = _Pieces(left.schema.field("id").type, piece_rows)
        out.add(key[0].as_py(), key[1].as_py(), edits, counts, plan["alone"])
        return pa.Table.from_batches([out.batch()])

    found = (
        edges.groupBy("id", "part")
        .cogroup(seen.groupBy("id", "part"))
        .applyInArrow(summarise, f"id {kind}, part int, found string")
    )
    plans = found.groupBy("id").applyInPandas(
        link, f"id {kind}, part int, start int, end int, gap long, odd long, alone boolean"
    )
    notes = plans.unionByName(seen, allowMissingColumns=True)
    return (
        edges.groupBy("id", "part").cogroup(notes.groupBy("id", "part")).applyInArrow(finish, _schema(kind))
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present), damaged by crc32(`conv_id:turn`) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes its role user.
    Nulls count as one space; dropped rows stay as not present, so that their conversation does.
    """
    space = F.lit(" ")

    def spaced(name: str):
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spaced("text"), ".!?", ""))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def digests(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Rows (id_col, *COUNTS, audit, repaired_sha256), one for each conversation of `repair`.

    The hash is of `role:text` lines in order. Conversations of one piece are hashed where they
    are; those of more are read in order, in one task each as SHA-256 goes, a batch at a time.
    """
    line = F.transform(
        F.filter("rows", lambda r: r.edit != "D"), lambda r: F.concat(r.role, F.lit(":"), r.text)
    )
    audit = F.array_join(F.transform("rows", lambda r: r.edit), "")
    lined = pieces.select(
        id_col,
        "place",
        "single",
        *COUNTS,
        audit.alias("audit"),
        F.array_join(line, "\n").alias("lines"),
        F.size(line).alias("n_lines"),
    )
    single = lined.filter("single").select(id_col, *COUNTS, "audit", F.sha2("lines", 256).alias("repaired_sha256"))
    columns = [*COUNTS, "audit", "lines", "n_lines"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, key, done = False, None, []
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for one, *values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or one != key:
                    if begun:
                        done.append((key, *counts, "".join(audits), sha.hexdigest()))
                    begun, key, counts, audits, sha, empty = True, one, [0] * len(COUNTS), [], hashlib.sha256(), True
                counts = [a + b for a, b in zip(counts, values, strict=False)]
                audits.append(values[-3])
                if values[-1]:
                    sha.update((b"" if empty else b"\n") + values[-2].encode())
                    empty = False
        if begun:
            done.append((key, *counts, "".join(audits), sha.hexdigest()))
            kinds = [id_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            names = [id_col, *COUNTS, "audit", "repaired_sha256"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names
            )

    several = (
        lined.filter("NOT single")
        .repartition(id_col)
        .sortWithinPartitions(id_col, "place")
        .select(id_col, *columns)
        .mapInArrow(read, T.StructType([f for f in single.schema.fields]))
    )
    return single.unionByName(several)
