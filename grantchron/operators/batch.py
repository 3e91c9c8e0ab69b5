"""From bronze to the batch a merge works on (C1-C4), the cursor (T4, E2) and quarantine (V8)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantchron.functions.times import business_time, capture_time, closes_access, since_epoch
from grantchron.model import GRANTS, KNOWN_OPS, ChangeSpec
from grantchron.operators.ordered import OrderedRuns

Cursor = tuple[int, ...]

#: What relate_events adds to the columns of a batch.
RELATED = ("is_first", "is_last", "next_ts", "next_op", "next_closes", "origin", "had_delete", "changed")


def beyond(columns, values) -> Column:
    """Strictly after `values` in the order of `columns`, with a plain >= for scan pruning."""
    pairs = list(zip(columns, values, strict=True))
    steps = []
    for i, (name, value) in enumerate(pairs):
        equal = [F.col(n) == F.lit(v) for n, v in pairs[:i]]
        steps.append(reduce(lambda a, b: a & b, [*equal, F.col(name) > F.lit(value)]))
    if len(steps) == 1:
        return steps[0]
    first, least = pairs[0]
    return (F.col(first) >= F.lit(least)) & reduce(lambda a, b: a | b, steps)


def after_cursor(bronze: DataFrame, cursor: Cursor | None, spec: ChangeSpec = GRANTS) -> DataFrame:
    """C1/E2. The cursor is a literal, so it reaches the Parquet statistics.

    spec.cursor names what to compare: the capture time alone misses late and tied rows,
    (capture time, sequence) misses late rows, an arrival position misses none.
    """
    if cursor is None:
        cursor = (0,)  # a log read for the first time starts at capture time 0
        if len(spec.cursor) > 1 or spec.cursor[0] != spec.capture_ns:
            return bronze
    fresh = bronze.filter(beyond(spec.cursor, cursor))
    if "capture_day" in bronze.columns and spec.cursor[0] == spec.capture_ns:
        day = since_epoch(str(cursor[0] // 1000)).cast("date")
        fresh = fresh.filter(F.col("capture_day") >= day)
    return fresh


def by_position(
    bronze: DataFrame, spec: ChangeSpec = GRANTS
) -> tuple[DataFrame, DataFrame]:
    """Events with a position, and those that no cursor can pass, as what it compares is missing."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.cursor])
    unplaced = bronze.filter(missing)
    if "capture_day" in bronze.columns and spec.cursor == (spec.capture_ns,):
        # Without a capture time there is no capture day: bronze keeps such rows in one folder.
        unplaced = unplaced.filter(F.col("capture_day").isNull())
    return bronze.filter(~missing), unplaced


def identity(events: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """Who an event is: key, capture time, sequence; without a capture time, all of its columns."""
    own = [c for c in events.columns if c != "capture_day"]
    return events.withColumns(
        {
            "capture_day": capture_time(spec.capture_ns).cast("date"),
            "digest": F.when(F.col(spec.capture_ns).isNull(), F.xxhash64(*own)),
        }
    )


def identity_columns(spec: ChangeSpec = GRANTS) -> list[str]:
    return ["capture_day", *spec.key, *spec.order, "digest"]


def not_taken(events: DataFrame, taken: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """Events whose identity is not among those taken; one small job finds the days to look at."""
    named = identity(events, spec)
    days = named.agg(
        F.min("capture_day").alias("first"), F.max("capture_day").alias("last")
    ).first()
    day = F.col("capture_day")
    if days["first"] is None:
        taken = taken.filter(day.isNull())
    else:
        taken = taken.filter(day.isNull() | day.between(days["first"], days["last"]))
    known = taken.select(*[F.col(c).alias(f"__{c}") for c in identity_columns(spec)])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in identity_columns(spec)]
    return named.join(known, reduce(lambda a, b: a & b, same), "left_anti").select(*events.columns)


def cursor_after(batch: DataFrame, cursor: Cursor | None, spec: ChangeSpec = GRANTS) -> DataFrame:
    """T4 as one row: the furthest position seen, or the old one when the batch is empty."""
    reached = F.max(F.struct(*spec.cursor))
    old = cursor if cursor is not None else (None,) * len(spec.cursor)
    return batch.agg(reached.alias("r")).select(
        *[F.coalesce(F.col(f"r.{c}"), F.lit(v)).cast("long").alias(c) for c, v in zip(spec.cursor, old)]
    )


def latest_per_key(events: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """C2. Only the first row of each sort run survives the map side, whatever the key's size."""
    w = Window.partitionBy(*spec.key).orderBy(*[F.col(c).desc() for c in spec.order])
    return events.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def stage(events: DataFrame, spec: ChangeSpec = GRANTS, keep=()) -> DataFrame:
    """C3 + C4: the columns every later step uses, and those to keep."""
    return events.select(
        *keep,
        *spec.key,
        *spec.attributes,
        F.col(spec.op).alias("op"),
        *dict.fromkeys((*spec.order, *spec.cursor)),
        business_time(spec).alias("business_ts"),
        closes_access(spec).alias("closes_access"),
    )


def judged(staged: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """V8: the rows with the reason why they are not fit to merge, or an empty one."""
    reason = F.concat_ws(
        ",",
        F.when(~F.coalesce(F.col("op").isin(*KNOWN_OPS), F.lit(False)), F.lit("op")),
        F.when(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.key]), F.lit("key")),
        F.when(F.col("business_ts").isNull(), F.lit("business_time")),
        F.when(F.col(spec.capture_ns).isNull(), F.lit("capture_time")),
    )
    return staged.withColumn("reason", reason)


def split_quarantine(staged: DataFrame, spec: ChangeSpec = GRANTS) -> tuple[DataFrame, DataFrame]:
    """V8: (rows fit to merge, rows that are not and why)."""
    rows = judged(staged, spec)
    return rows.filter("reason = ''").drop("reason"), rows.filter("reason <> ''")


def relate_events(
    staged: DataFrame,
    spec: ChangeSpec = GRANTS,
    mode: str = "all",
    hot_limit: int | None = None,
    with_origin: bool = True,
    tracked=(),
) -> DataFrame:
    """Give each event what the merges need to know of its key's other events in the batch.

    is_first, is_last  position within the key
    next_ts, next_op   business time and op of the following event; next_closes: it closes access
    origin             insert-only attributes of the event that began the current row:
                       the last event so far that inserted, that is, a non-delete that
                       comes first or right after a delete
    had_delete         a delete occurred so far
    changed            with tracked columns: these, or whether the event closes access, are not as
                       in the event before; true of the first, as that one is in another batch

    Origin and had_delete serve the current state only; with_origin=False leaves them out.

    mode="latest" keeps one event per key, as the merge of one event per run does;
    mode="all" keeps every event.
    """
    op = F.col("op")
    origin = F.struct(*[F.col(c) for c in spec.inserted_only])
    if mode == "latest":
        return latest_per_key(staged, spec).select(
            "*",
            F.lit(True).alias("is_first"),
            F.lit(True).alias("is_last"),
            F.lit(None).cast("timestamp_ntz").alias("next_ts"),
            F.lit(None).cast("string").alias("next_op"),
            F.lit(None).cast("boolean").alias("next_closes"),
            F.when(op != "d", origin).alias("origin"),
            F.coalesce(op == "d", F.lit(False)).alias("had_delete"),
            *([F.lit(True).alias("changed")] if tracked else []),
        )
    if mode != "all":
        raise ValueError(f"mode must be 'latest' or 'all', not {mode!r}")
    state = F.struct("closes_access", *tracked)
    runs = OrderedRuns(staged, spec.key, spec.order, hot_limit).add(
        prev={"__prev": F.struct("op", state.alias("state"))} if tracked else {"__prev": F.struct("op")},
        next={"__next": F.struct("business_ts", "op", "closes_access")},
    )
    first = F.col("__prev").isNull()
    related = [
        first.alias("is_first"),
        F.col("__next").isNull().alias("is_last"),
        F.col("__next.business_ts").alias("next_ts"),
        F.col("__next.op").alias("next_op"),
        F.col("__next.closes_access").alias("next_closes"),
        *([(~F.col("__prev.state").eqNullSafe(state)).alias("changed")] if tracked else []),
    ]
    if not with_origin:
        return runs.rows().select(*staged.columns, *related)
    inserts = (op != "d") & (first | (F.col("__prev.op") == "d"))
    runs = runs.add(
        last={"origin": F.when(inserts, origin), "__deleted": F.when(op == "d", F.lit(True))}
    )
    return runs.rows().select(
        *staged.columns,
        *related,
        "origin",
        F.coalesce(F.col("__deleted"), F.lit(False)).alias("had_delete"),
    )
