"""One merge of bronze into gold (T5): C1-C4, T1-T4 and a single commit."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from grantchron.model import ACCESS, Dimension
from grantchron.operators.batch import (
    RELATED,
    after_cursor,
    by_position,
    identity,
    judged,
    not_taken,
    relate_events,
    stage,
)
from grantchron.operators.scd import access_changes, scd1_merge, scd2_merge
from grantchron.plans import audit, dimensions
from grantchron.plans.store import Commit, GoldStore, new_batch

# A batch is broadcast if it has no more keys and no more bytes of staged Parquet than these.
BROADCAST_KEYS = 200_000
BROADCAST_BYTES = 16 << 20

CURSOR = "cursor"  # the name among sources of runs without a stream


def run_merge(
    store: GoldStore,
    bronze: DataFrame,
    mode: str = "all",
    prerevoked: str = "open",
    stream: str | None = None,
    batch_id: int | None = None,
    hot_limit: int | None = None,
    changes: str = "record",
    access=ACCESS,
) -> Commit:
    """Bring gold up to date with bronze; without new events, change nothing.

    With a stream (its id, which a new checkpoint changes) and batch_id, bronze is that
    micro-batch: all of it is new, unless the store has taken the batch already or, where
    gold was also fed by others, the event itself. Otherwise rows beyond the stored cursor
    are new, and rows without a position that were not seen before.

    changes="access" starts a period only where one of the `access` columns changes (E4), within a
    batch and from one to the next; "record" does so at each event. A store keeps to one of them.
    """
    spec, before = store.spec, store.latest()
    _agree(before, changes, prerevoked)
    source = CURSOR if batch_id is None else stream
    if batch_id is None:
        placed, unplaced = by_position(bronze, spec)
        events = after_cursor(placed, before.cursor, spec).unionByName(unplaced)
        if before.quarantine:  # unfit events do not move the cursor, and are taken once
            events = not_taken(events, store.taken(before), spec)
        if events.isEmpty():
            return before
    elif before.streams.get(stream, -1) >= batch_id:
        return before
    else:
        events = bronze
        if before.streams.keys() - {stream}:
            events = not_taken(events, store.taken(before), spec)

    batch = new_batch(before.version + 1)
    streams = {**before.streams, source: before.version if batch_id is None else batch_id}
    tracked = access if changes == "access" else ()
    staged = _write_staged(store, events, batch, mode, hot_limit, tracked)
    related = staged.filter("reason IS NULL")
    summary = staged.agg(
        F.max(F.when(F.col("reason").isNull(), F.struct(*spec.cursor))).alias("reached"),
        F.count("reason").alias("unfit"),
        F.collect_set("bucket").alias("touched"),  # at most store.buckets values
        F.count_if("is_first").alias("keys"),
        F.count(F.lit(1)).alias("events"),
        *[F.collect_set(_bucket_of(store, dim)).alias(dim.name) for dim in store.dimensions],
    ).first()
    # Mode "latest" stages one event of a key, but has taken all.
    named = identity(events, spec) if mode == "latest" else staged
    writes = [(store.write_taken, named)]
    taken, quarantine = [*before.taken, batch], list(before.quarantine)
    if summary["unfit"]:
        unfit = staged.filter("reason IS NOT NULL").drop("digest", "bucket", *RELATED)
        writes.append((store.write_quarantine, unfit))
        quarantine.append(batch)
    if summary["reached"] is None:  # nothing to merge
        _write_together(store, writes, batch)
        commit = replace(
            before,
            version=before.version + 1,
            streams=streams,
            quarantine=quarantine,
            taken=taken,
            events=before.events + summary["events"],
        )
        store.publish(commit)
        store.drop_staged(batch)
        return commit

    touched = summary["touched"]
    few_keys = summary["keys"] <= BROADCAST_KEYS and store.bytes_staged(batch) <= BROADCAST_BYTES
    open_rows = store.open_periods(before, touched, with_pending=True)
    current = store.current(before, touched)
    starting = related
    if changes == "access":
        starting = access_changes(related, open_rows, spec, access, few_keys, hot_limit)
    writes.append((store.write_history, scd2_merge(open_rows, starting, spec, prerevoked, few_keys)))
    writes.append((store.write_current, scd1_merge(current, related, spec, few_keys)))
    commit = Commit(
        version=before.version + 1,
        cursor=_further(before.cursor, summary["reached"]),
        streams=streams,
        closed=[*before.closed, batch],
        open={**before.open, **dict.fromkeys(touched, batch)},
        current={**before.current, **dict.fromkeys(touched, batch)},
        quarantine=quarantine,
        taken=taken,
        changes=changes,
        events=before.events + summary["events"],
    )

    def facts() -> dict:
        _write_together(store, writes, batch)
        if before.prints or not before.closed:  # a store from before there were prints has none
            return audit.prints_after(store, before, commit, batch)
        return {}

    def dimension(dim: Dimension) -> dict[str, dict]:
        found = dimensions.load(store, before, dim, related, batch, summary[dim.name], hot_limit)
        if not found:
            return {}
        write, versions, state = found
        write(versions, batch)
        return {dim.name: state}

    # Facts and dimensions do not need each other; all are written before the commit.
    prints, *found = _together(store, [(facts,), *[(dimension, dim) for dim in store.dimensions]])
    dims = reduce(lambda states, state: {**states, **state}, found, before.dims)
    commit = replace(commit, dims=dims, prints=prints)
    store.publish(commit)
    store.drop_staged(batch)
    return commit


def _bucket_of(store: GoldStore, dim: Dimension) -> Column:
    """The bucket of the key that a fit event names, if it names one."""
    return F.when(F.col("reason").isNull() & F.col(dim.key).isNotNull(), store.bucket(dim.key))


def _agree(before: Commit, changes: str, prerevoked: str) -> None:
    if changes not in ("record", "access"):
        raise ValueError(f"changes must be 'record' or 'access', not {changes!r}")
    if changes == "access" and prerevoked != "open":
        raise ValueError("changes='access' needs prerevoked='open': rows that ended on arrival are not open")
    if before.closed and before.changes != changes:
        raise ValueError(f"the store's periods are those of {before.changes} changes")


def _write_together(store: GoldStore, writes: list, batch: str) -> None:
    """None of the writes needs another; all end before the commit."""
    _together(store, [(write, rows, batch) for write, rows in writes])


def _together(store: GoldStore, calls: list[tuple]) -> list:
    """The results of calls (function, *arguments) that do not need each other."""
    if not calls:
        return []
    inherit = inheritable_thread_target(store.spark)
    with ThreadPoolExecutor(len(calls)) as workers:
        running = [workers.submit(inherit(call), *arguments) for call, *arguments in calls]
    return [r.result() for r in running]


def _write_staged(
    store: GoldStore, events: DataFrame, batch: str, mode: str, hot_limit: int | None, tracked=()
) -> DataFrame:
    """M5: the batch as every later step reads it, events unfit to merge set apart.

    Written rather than cached: a lost executor costs no recomputation, and cursor and
    tables are derived from the same rows even if the source has grown meanwhile.
    """
    spec = store.spec
    named = [c for dim in store.dimensions for c in dim.schema.names if c not in spec.fact_columns]
    rows = judged(stage(identity(events, spec), spec, keep=["digest", *dict.fromkeys(named)]), spec)
    fit = F.col("reason") == ""
    if mode == "latest":  # which keeps one event of a key, but every unfit one
        related = relate_events(rows.filter(fit), spec, mode, hot_limit, tracked=tracked)
        rows = related.unionByName(rows.filter(~fit), allowMissingColumns=True)
    else:  # in one pass over the batch: unfit events are related among themselves, to no use
        apart = replace(spec, key=(*spec.key, "fit"))
        rows = relate_events(rows.withColumn("fit", fit), apart, mode, hot_limit, tracked=tracked).drop("fit")
    rows = rows.withColumns(
        {
            "bucket": F.when(fit, store.bucket()),
            "is_first": F.col("is_first") & fit,
            "reason": F.when(~fit, F.col("reason")),
        }
    )
    return store.stage(rows, batch)


def _further(old, reached) -> list[int]:
    """T4: never back, and unchanged when nothing was read."""
    return list(max(tuple(old), tuple(reached))) if old else list(reached)
